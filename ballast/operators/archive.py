"""Retention of the per-asset history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = 1000


def _last_archived(rows: DataFrame, id_col: str, keep: int) -> Column:
    """Highest id to archive, as a scalar subquery: evaluated once and then a
    plain literal in the filter. NULL (nothing qualifies) up to ``keep``."""
    top = F.max(id_col)
    return rows.agg(F.when(top > keep, top - keep)).scalar()


def archived(rows: DataFrame, id_col: str, keep: int = KEEP) -> DataFrame:
    """Rows with an id of at most ``max - keep``."""
    return rows.filter(F.col(id_col) <= _last_archived(rows, id_col, keep))


def retained(rows: DataFrame, id_col: str, keep: int = KEEP) -> DataFrame:
    """The other rows; all of them while the highest id is at most ``keep``."""
    last = _last_archived(rows, id_col, keep)
    return rows.filter(last.isNull() | (F.col(id_col) > last))


def archive(rows: DataFrame, id_col: str, keep: int = KEEP) -> tuple[DataFrame, DataFrame]:
    return archived(rows, id_col, keep), retained(rows, id_col, keep)


def append_ignore_dup(stored: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that really get appended: one per key, and no key stored before.

    Stored keys drop out first: that join leaves the others placed and sorted by key, so
    choosing one of each neither moves nor sorts them again.
    """
    key = list(key)
    rest = [name for name in rows.columns if name not in key]
    fresh = rows.join(stored.select(*key), key, "left_anti")
    once = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("row"))
    once = once.select(*key, *[F.col(f"row.{name}").alias(name) for name in rest])
    return once.select(rows.columns)
