"""Quality rules, and a log-likelihood ratio between a trusted target and the raw corpus.

Words and pairs of adjacent words are hashed into ``BUCKETS`` buckets. Counts over all
trusted documents and over all documents give two multinomials, both smoothed by one.
A document's ratio is the sum over its n-grams of the log of target over raw chance,
divided by the number of n-grams. It is kept if the rules pass and the ratio reaches a
threshold. That is taken from trusted documents that pass the rules and whose ids'
checksums keep them out of the target counts: ``SPREAD`` times as far below the median of
their ratios as the lowest hundredth (exact percentiles of ratios to four decimals). There
is no randomness, so a document's verdict depends on the two corpora alone.

The ratios of all ``BUCKETS`` buckets are one value that every task has. Everything else
happens within the row, or in sums by bucket that are combined before their shuffle; only
trusted texts are joined, with ids that are broadcast up to ``FEW_IDS``. The number of
buckets does not grow: in a very large corpus each holds many n-grams, and the ratio tells
frequent n-grams apart, not rare ones.
Windows of three words are compared by 64-bit hashes of their own.

A null text has no words. Without words the ratio is 0. Without trusted documents all
ratios are 0 and the rules decide; without such that are kept out of the counts, the rules
decide alone. Repeated rows are judged each for itself; trusted ids
that are repeated, null or unknown change nothing. Other columns do not interfere, and
are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.sizing import sized_broadcast, staged
from ballast.llm.shared import id_bucket, whole, words

BUCKETS = 1 << 14
SPREAD = 2.0
PARTS = 5  # one of so many trusted documents is kept out of the target counts
FEW_IDS = 1_000_000  # ids that are broadcast at most, 8 bytes each
LEAST_WORDS = 50
# Fixed by the contract.
SYMBOLS = "[#*$%&|<>]"


def bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def pairs(w: Column) -> Column:
    """Hashes of each word with the next."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))


def buckets(w: Column, pair: Column) -> Column:
    """Buckets of the words and of the pairs."""
    single = F.transform(w, lambda a: bucket(F.xxhash64(a)))
    return F.concat(single, F.transform(pair, bucket))


def _windows(w: Column, pair: Column) -> Column:
    """64-bit hashes of each run of three words."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    return F.zip_with(F.slice(pair, 1, n), F.slice(w, 3, n), lambda ab, c: F.xxhash64(ab, c))


def _neighbours(placed: Column) -> Column:
    """Places of windows that are equal to the one before or after in sorted order."""
    none = F.struct(F.lit(None).cast("bigint").alias("t"), F.lit(-1).alias("i"))
    before = F.concat(F.array(none), F.slice(placed, 1, F.size(placed) - 1))
    after = F.concat(F.slice(placed, 2, F.size(placed)), F.array(none))
    marked = F.zip_with(
        F.zip_with(placed, before, lambda x, y: F.struct(x["i"].alias("i"), x["t"].alias("t"), (x["t"] == y["t"]).alias("same"))),
        after,
        lambda x, y: F.when(
            F.coalesce(x["same"], F.lit(False)) | F.coalesce(x["t"] == y["t"], F.lit(False)), x["i"]
        ),
    )
    return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))


def _covered(places: Column) -> Column:
    """Words in the windows at these places: each adds those of its three words that
    the place before has not."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda s, i: F.struct(
            i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")
        ),
        lambda s: s["n"],
    )


def rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the rules' figures (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed), the words ``w`` and their ``pair`` hashes."""
    source = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    cut = source.select(
        "*",
        words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    ).withColumn("pair", pairs(F.col("w")))
    measured = cut.select(
        "doc_id",
        "w",
        "pair",
        F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, "")))
        .cast("bigint")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _windows(F.col("w"), F.col("pair")).alias("windows"),
    )
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(
        F.transform("windows", lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    )
    counted = (
        measured.withColumn("placed", F.when(repeats, placed))
        .withColumn("places", F.when(F.col("placed").isNotNull(), _neighbours(F.col("placed"))))
        .withColumn("n_repeat_words", F.coalesce(_covered(F.col("places")), F.lit(0)).cast("bigint"))
        .drop("windows", "placed", "places")
    )
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )


def _of(docs: DataFrame, ids: DataFrame, doc_id: str) -> DataFrame:
    return docs.join(sized_broadcast(ids, FEW_IDS), docs[doc_id] == ids["id"], "left_semi")


def _counts(docs: DataFrame, text: str, out: str) -> DataFrame:
    return (
        docs.select(words(F.col(text)).alias("w"))
        .withColumn("pair", pairs(F.col("w")))
        .select(F.explode(buckets(F.col("w"), F.col("pair"))).alias("h"))
        .groupBy("h")
        .agg(F.count("*").alias(out))
    )


def ratio_table(docs: DataFrame, target: DataFrame, doc_id: str, text: str) -> DataFrame:
    """h, log_ratio for every bucket that occurs; ``target`` has the ids of the target."""
    raw = _counts(docs, text, "raw")
    good = _counts(_of(docs, target, doc_id), text, "good")
    stored = staged(raw.join(good, "h", "left").na.fill(0, ["good"]), "buckets")
    sums = stored.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    raw, good = sums["raw"] or 0, sums["good"] or 0
    ratio = F.log((F.col("good") + 1) / F.lit(float(good + BUCKETS))) - F.log(
        (F.col("raw") + 1) / F.lit(float(raw + BUCKETS))
    )
    return stored.select("h", (ratio if good else F.lit(0.0)).alias("log_ratio"))


def ratios(docs: DataFrame, table: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rules' figures and the ratio of every row."""
    # The ratios of all buckets in their order, one value of bounded size for all rows.
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("h"))
    known = (
        every.join(F.broadcast(table), "h", "left")
        .agg(F.sort_array(F.collect_list(F.struct("h", F.coalesce("log_ratio", F.lit(0.0)).alias("r")))).alias("all"))
        .select(F.col("all.r"))
        .scalar()
    )
    total = F.aggregate(
        "hashed", F.lit(0.0), lambda s, h: s + F.element_at("ratios", h + 1)
    )
    n = F.size("hashed")
    return (
        rules(docs, doc_id, text)
        .withColumn("hashed", buckets(F.col("w"), F.col("pair")))
        # Read once, so Catalyst puts the value itself in its place.
        .withColumn("ratios", known)
        .withColumn("ratio", F.when(n == 0, F.lit(0.0)).otherwise(total / n))
    )


def threshold(docs: DataFrame, held: DataFrame, table: DataFrame, doc_id: str, text: str) -> float:
    """From the ratios of the trusted documents that are not in the target counts."""
    # Stored, for Spark would push a filter below the projections and work them out twice.
    scored = staged(ratios(_of(docs, held, doc_id), table, doc_id, text).select("base_failed", "ratio"), "held")
    found = (
        scored.filter("not base_failed")
        .groupBy(F.round("ratio", 4).alias("r"))
        .agg(F.count("*").alias("n"))
        .agg(F.percentile("r", F.array(F.lit(0.01), F.lit(0.5)), F.col("n")).alias("p"))
        .first()["p"]
    )
    return found[1] - SPREAD * (found[1] - found[0]) if found else float("-inf")


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: float | None = None,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, the rules' figures, ratio, kept. ``trusted`` has
    the trusted ids; ``least`` sets the threshold."""
    ids = trusted.select(F.col(doc_id).alias("id")).filter("id is not null").distinct()
    ids = staged(ids.withColumn("held", id_bucket(F.col("id"), PARTS) == 0), "trusted")
    table = ratio_table(docs, ids.filter("not held").select("id"), doc_id, text)
    if least is None:
        least = threshold(docs, ids.filter("held").select("id"), table, doc_id, text)
    scored = ratios(docs, table, doc_id, text)
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "ratio",
        (~F.col("base_failed") & (F.col("ratio") >= F.lit(least))).alias("kept"),
    )
