"""Columns and joins that several corpus operators need."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contract: what separates words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# A key with at least a 2000th of all rows is hot, so there are at most 2000 of them.
HOT_SHARE = 2000
SALTS = 4096


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words of a text as an array; empty for a null or blank text."""
    return F.array_remove(F.split(whole(text), SPACE + "+"), "")


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def attach(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, hot_at: int, spread: Column
) -> DataFrame:
    """``rows`` left-joined to ``groups`` (one row per key, ``size`` rows each),
    without sending a hot key's rows to one task.

    Groups of ``hot_at`` rows or more are broadcast; the caller chooses it as a
    fraction of the number of rows, which bounds how many there are. In the second,
    shuffled join rows that met a hot group have a number drawn from ``spread`` in
    place of their key; what that may meet is ignored. The keys are dropped and must
    not be null.
    """
    values = [c for c in groups.columns if c not in keys]
    kinds = dict(groups.dtypes)
    hot = groups.filter(F.col(size) >= hot_at).select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys], *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    met = rows.join(F.broadcast(hot), [F.col(k) == F.col(f"_hot_{k}") for k in keys], "left")
    number = F.pmod(F.xxhash64(spread), F.lit(SALTS))
    salted = met.select(
        "*",
        *[
            F.when(F.col(f"_hot_{size}").isNull(), F.col(k))
            .otherwise(number.cast(kinds[k]))
            .alias(f"_cold_{k}")
            for k in keys
        ],
    ).drop(*keys, *[f"_hot_{k}" for k in keys])
    cold = groups.select(
        *[F.col(k).alias(f"_cold_{k}") for k in keys],
        *[F.col(v).alias(f"_cold_v_{v}") for v in values],
    )
    joined = salted.join(cold, [f"_cold_{k}" for k in keys], "left")
    for v in values:
        joined = joined.withColumn(v, F.coalesce(f"_hot_{v}", f"_cold_v_{v}"))
    return joined.drop(
        *[f"_cold_{k}" for k in keys],
        *[f"_cold_v_{v}" for v in values],
        *[f"_hot_{v}" for v in values],
    )


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task that gives back, when it ends, what its worker holds but does not use;
    workers live on, and would hold the most any task has needed."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
