"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in the order of their ids, fill blocks of ``BLOCK`` characters.
A source of weight w releases its j-th block (from 0) at slot floor(j / w) and must have
it placed before slot ceil((j + 1) / w). One block is placed per slot: of the released
ones that with the earliest deadline. As long as every source has blocks left, the
blocks a source has had after any number of slots differ from its share by less than one.

Weights are whole numbers of slots in a cycle, so the schedule repeats with the cycle
and every release and deadline is exact. The cycle is worked out once from the weights,
one entry per slot; blocks are then placed by a join, with no sequence over the data.
Slots whose source has run out stay empty; nothing is left out or repeated.

``weights`` is a table with one row per source; that, and the cycle made of it, is what
the driver sees. Sources that it does not name share one more slot as one source.

Blocks are numbered by running sums within ranges of (source, id), shifted by the sums of
the ranges before, so that a source with a large part of all rows is spread over tasks.

A null source counts as the empty name, a null text as empty. Rows with equal ids are
ordered by their text's hash; equal rows come one after the other. Documents belong to
the block in which they begin. Other columns pass through ``mixed``.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ballast.functions.sizing import staged
from ballast.llm.shared import free_name, whole

BLOCK = 65_536
CYCLE = 1024
# Stands for sources without a weight of their own; no source has this name.
OTHERS = "\x00others"


def whole_slots(weights: dict[str, float], cycle: int = CYCLE) -> dict[str, int]:
    """Weights as slots of a cycle of at least ``cycle``: each source at least one, the
    others by largest remainder, ties by name. A weight that is null, not finite, or
    not above zero is no weight: its source is left to the others' slot."""
    weights = {k: w for k, w in weights.items() if w is not None and 0 < w < math.inf}
    names = sorted(weights)
    if not names:
        return {}
    cycle = max(cycle, 4 * len(names))
    total = sum(weights.values())
    exact = {k: Fraction(weights[k]) / Fraction(total) * (cycle - len(names)) for k in names}
    slots = {k: 1 + int(exact[k]) for k in names}
    left = cycle - sum(slots.values())
    for k in sorted(names, key=lambda k: (int(exact[k]) - exact[k], k))[:left]:
        slots[k] += 1
    return slots


def cycle_slots(slots: dict) -> list[tuple]:
    """(source, block of the cycle, slot, release, deadline) of one cycle.

    Earliest deadline first over the released blocks; a source has one at a time.
    """
    names = list(slots)
    cycle = sum(slots.values())
    waiting = [(0, -(-cycle // slots[k]), i, 0) for i, k in enumerate(names)]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    placed = []
    for slot in range(cycle):
        while waiting and waiting[0][0] <= slot:
            release, deadline, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, i, j, release))
        deadline, i, j, release = heapq.heappop(ready)
        n = slots[names[i]]
        placed.append((names[i], j, slot, release, deadline))
        if j + 1 < n:
            heapq.heappush(
                waiting, ((j + 1) * cycle // n, -(-(j + 2) * cycle // n), i, j + 1)
            )
    return placed


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A broadcast table of the driver's rows. They go over as Arrow: of a list Spark makes
    an RDD, for which each executor starts Python workers that then stand idle."""
    names = [column.split()[0] for column in schema.split(", ")]
    columns = zip(names, zip(*rows)) if rows else ((name, ()) for name in names)
    return F.broadcast(spark.createDataFrame(pa.table({k: pa.array(v) for k, v in columns}), schema))


def tempered(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Weights by the square root of each source's characters: source, weight."""
    return docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).agg(
        F.sqrt(F.sum(F.char_length(whole(F.col(text)))) + 1.0).alias("weight")
    )


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``begins``, the character of its component at which a document begins, and
    ``block``, the number of that character's block, to rows of row_id, doc_id,
    component, n_chars and tie."""
    order = ["component", "doc_id", "tie", "row_id"]
    # Stored, so that both uses below see the same ranges.
    ranged = staged(
        rows.repartitionByRange(*order).withColumn("cell", F.spark_partition_id()), "ranges"
    )
    sums = ranged.groupBy("component", "cell").agg(F.sum("n_chars").alias("chars"))
    before = Window.unboundedPreceding, -1
    earlier = Window.partitionBy("component").orderBy("cell").rowsBetween(*before)
    shift = sums.select(
        "component", "cell", F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("shift")
    )
    within = (
        Window.partitionBy("component", "cell")
        .orderBy("doc_id", "tie", "row_id")
        .rowsBetween(*before)
    )
    return (
        ranged.join(shift, ["component", "cell"])
        .withColumn("begins", F.coalesce(F.sum("n_chars").over(within), F.lit(0)) + F.col("shift"))
        .withColumn("block", F.expr(f"begins div {block}"))
        .drop("tie", "cell", "shift")
    )


def schedule(
    docs: DataFrame,
    weights: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block: int = BLOCK,
    cycle: int = CYCLE,
) -> DataFrame:
    """A row per row of ``docs``: row_id, doc_id, source, n_chars, block, slot, release,
    deadline, begins. Sorting by (slot, begins, row_id) gives the mixture."""
    spark = docs.sparkSession
    slots = whole_slots({r["source"]: r["weight"] for r in weights.collect()}, cycle)
    given = list(slots)
    names = _small(spark, [(k, k) for k in given], "source string, component string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.char_length(whole(F.col(text))).cast("bigint").alias("n_chars"),
        F.xxhash64(text).alias("tie"),
    )
    if not rows.select("source").join(names, "source", "left_anti").isEmpty():
        slots[OTHERS] = 1
    size = sum(slots.values())
    share = _small(spark, list(slots.items()), "component string, per_cycle bigint")
    table = _small(
        spark, cycle_slots(slots), "component string, in_cycle bigint, at bigint, from bigint, to bigint"
    )
    placed = rows.join(names, "source", "left").withColumn(
        "component", F.coalesce("component", F.lit(OTHERS))
    )
    return (
        blocks(placed, block)
        .join(share, "component")
        .withColumn("in_cycle", F.expr("block % per_cycle"))
        .withColumn("passed", F.expr("block div per_cycle") * size)
        .join(table, ["component", "in_cycle"])
        .select(
            "row_id",
            "doc_id",
            "source",
            "n_chars",
            "block",
            (F.col("passed") + F.col("at")).alias("slot"),
            (F.col("passed") + F.col("from")).alias("release"),
            (F.col("passed") + F.col("to")).alias("deadline"),
            "begins",
        )
    )


def mixed(docs: DataFrame, weights: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture. ``docs`` is a stored table: its
    rows are told apart by their place in the scan."""
    place, slot, begins = (free_name(docs, c) for c in ("_place", "_slot", "_begins"))
    slots = staged(schedule(docs, weights, **names), "slots").select(
        F.col("row_id").alias(place), F.col("slot").alias(slot), F.col("begins").alias(begins)
    )
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    return placed.join(slots, place).sort(slot, begins, place).drop(place, slot, begins)
