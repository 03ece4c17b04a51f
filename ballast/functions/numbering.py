"""Dense numbering without sending a whole group through one task.

``row_number`` over a big group sorts that group in a single task. Here rows are range
partitioned by their order and sorted within partitions, which gives each its place in its
partition; the partition's first number is the sum of the sizes of those before it. Ranges
are sampled from the keys, so it does not matter how far apart ids lie. Only one row per
partition is ever ordered together.

The ranges are stored once, so every use sees the same ones. A group's numbers start at
one by taking off the number before its first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.sizing import staged

# What monotonically_increasing_id puts the partition's number above.
PLACE_BITS = 33


def _numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``out`` counts from 1 in the order of ``order``, whose values are unique."""
    # Stored first: the sampling of ranges would work the input out a second time.
    ranged = staged(
        staged(df, "rows")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranges",
    ).withColumn("_part", F.shiftright("_place", PLACE_BITS))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    place = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        ranged.join(F.broadcast(skips), "_part")
        .withColumn(out, (place + F.col("_skip") + 1).cast("bigint"))
        .drop("_place", "_part", "_skip")
    )


def number_by_id(df: DataFrame, key: str, out: str, group: Sequence[str] = ()) -> DataFrame:
    """``row_number() over (partition by group order by key)`` for a key that is unique
    within its group."""
    group = list(group)
    numbered = _numbered(df, [*group, key], out)
    if not group:
        return numbered
    firsts = numbered.groupBy(*group).agg(F.min(out).alias("_first"))
    return (
        numbered.join(firsts, group)
        .withColumn(out, F.col(out) - F.col("_first") + 1)
        .drop("_first")
    )


def number_by_pair(df: DataFrame, major: str, minor: str, out: str) -> DataFrame:
    """``row_number() over (order by major, minor)`` over the whole frame, for pairs that
    are unique."""
    return _numbered(df, [major, minor], out)


def successor_of(df: DataFrame, key: str, out: str) -> DataFrame:
    """Each row of unique keys with the next key, null after the last."""
    numbered = _numbered(df, [key], "_no")
    follow = numbered.select((F.col("_no") - 1).alias("_no"), F.col(key).alias(out))
    return numbered.join(follow, "_no", "left").drop("_no")


def continue_after(stored: DataFrame | None, id_col: str) -> Column:
    """Highest id handed out so far, as a scalar subquery; 0 without any."""
    if stored is None:
        return F.lit(0).cast("bigint")
    return stored.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()
