"""Dates and helpers that the core tests share."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame

AS_OF = "2024-02-01 00:00:00"
OPEN = datetime(1900, 1, 1)
THEN = datetime(2024, 1, 1)


def dec(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.000001"))


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
