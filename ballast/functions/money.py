"""Exact decimal arithmetic.

Every amount, price and unit count is ``decimal(20,6)``; products keep nine
fractional digits (Spark's own rule for two ``decimal(20,6)`` factors) and are
rounded to six exactly where a value is stored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(20,6)"
WEIGHT = "decimal(9,6)"
INTEGER = "decimal(38,0)"
MICROS_PER_UNIT = 1_000_000


def amount(value: Column) -> Column:
    """Round to the stored precision."""
    return value.cast(AMOUNT)


def amount_or_null(value: Column) -> Column:
    """Round to the stored precision; NULL where the value does not fit."""
    return value.try_cast(AMOUNT)


def zero() -> Column:
    return F.lit(0).cast(AMOUNT)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, zero())


def micros(value: Column) -> Column:
    """A six-digit decimal as a whole number of millionths."""
    return (value * F.lit(MICROS_PER_UNIT)).cast(INTEGER)


def share_units(total: Column, weight: Column, price: Column) -> Column:
    """``total * weight / price`` rounded half-up once, to six digits.

    The product is widened first so that Spark's result scale is six: a wider
    scale would round twice and could cross a tie. NULL if the price is zero
    or the quotient does not fit.
    """
    return amount_or_null(F.try_divide((total * weight).cast("decimal(38,12)"), price))
