"""Exact duplicates by naming blocks.

Each normalised text is cut into blocks of a fixed number of characters. Distinct
blocks are sorted and numbered; a number stands for one content, never for a hash of
it. Then adjacent names of a document are paired, distinct pairs are numbered in the
same way, and so on, until each document has one name. Two documents with as many
blocks have the same name if and only if their texts are equal.

Numbers come from sorted partitions, so no task sees all keys. Each level is written
to the shared folder before it is used, so a name never changes once given. Blocks
and pairs that very many documents share are joined by broadcast (see ``attach``).

A null text is the empty text; both are one group of copies. Repeated rows, also with
equal ids, count as rows of their group. A null id never stays unless all ids of the
group are null. Other columns, also such that clash with ours, pass through
``drop_copies`` untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.sizing import staged
from ballast.llm.shared import HOT_SHARE, attach, free_name, whole

BLOCK = 1024
NO_NAME = -(2**63)


def normalised(text: Column) -> Column:
    """Each run of white space as one space; single spaces are left alone."""
    return F.regexp_replace(whole(text), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _named(rows: DataFrame, keys: list[str], hot_at: int) -> DataFrame:
    """``rows`` with ``name``, equal where all ``keys`` are equal, in their place."""
    distinct = rows.groupBy(*keys).agg(F.count("*").alias("_size"))
    sorted_keys = distinct.sortWithinPartitions(*keys)
    # Each of the two joins numbers for itself; the sign keeps their names apart.
    number = F.monotonically_increasing_id()
    named = sorted_keys.withColumn(
        "name", F.when(F.col("_size") >= hot_at, -1 - number).otherwise(number)
    )
    return attach(rows, named, keys, "_size", hot_at, F.struct("row_id", "place")).drop("_size")


def identities(docs: DataFrame, doc_id: str, text: str, block: int = BLOCK) -> DataFrame:
    """A row per row of ``docs``: row_id, doc_id, text_sha256, n_blocks, name.

    ``row_id`` is the place in the scan of ``docs``.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.ceil(F.char_length(F.col(text)) / block) + 1)).first()[0] or 0
    hot_at = max(2, total // HOT_SHARE)
    cut = (
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(doc_id).alias("doc_id"),
            normalised(F.col(text)).alias("text"),
        )
        .withColumn(
            "blocks",
            F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(
                F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
            ),
        )
        .select(
            "row_id",
            "doc_id",
            F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
            F.size("blocks").alias("n_blocks"),
            F.posexplode("blocks").alias("place", "block"),
        )
        # The first block carries what belongs to the document.
        .withColumn("doc_id", F.when(F.col("place") == 0, F.col("doc_id")))
        .withColumn("sha", F.when(F.col("place") == 0, F.unhex("sha")))
        .withColumn("left_over", F.col("n_blocks"))
    )
    level = staged(_named(cut, ["block"], hot_at), "names")
    done = [level.filter("left_over = 1")]
    longest = level.agg(F.max("left_over")).first()[0] or 1
    while longest > 1:
        pairs = (
            level.filter("left_over > 1")
            .groupBy("row_id", F.expr("place div 2").cast("int").alias("place"))
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.max("sha").alias("sha"),
                F.max("n_blocks").alias("n_blocks"),
                F.max(F.expr("(left_over + 1) div 2")).cast("int").alias("left_over"),
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"),
                F.coalesce(
                    F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(NO_NAME)
                ).alias("second"),
            )
        )
        level = staged(_named(pairs, ["first", "second"], hot_at), "names")
        done.append(level.filter("left_over = 1"))
        longest = (longest + 1) // 2
    columns = ["row_id", "doc_id", F.lower(F.hex("sha")).alias("text_sha256"), "n_blocks", "name"]
    found = done[0].select(*columns)
    for more in done[1:]:
        found = found.unionByName(more.select(*columns))
    return found


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: row_id, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays, of equal ids the first row.
    """
    found = identities(docs, doc_id, text)
    groups = staged(
        found.groupBy("n_blocks", "name").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_id")).alias("k"),
            F.count("*").alias("group_size"),
        ),
        "groups",
    )
    # Two stored inputs: Spark splits a group that holds very many rows.
    return found.join(groups, ["n_blocks", "name"]).select(
        "row_id",
        "doc_id",
        F.col("k.doc_id").alias("keep_id"),
        "group_size",
        (F.col("k.row_id") == F.col("row_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay. ``docs`` is a stored table: its rows are told
    apart by their place in the scan. Only places of dropped rows are matched."""
    place = free_name(docs, "_place")
    gone = copies(docs, doc_id, text).filter("not kept").select(F.col("row_id").alias(place))
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    return placed.join(staged(gone, "gone"), place, "left_anti").drop(place)
