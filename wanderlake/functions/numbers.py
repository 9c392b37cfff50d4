"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_or_null(value: Column, precision: int, scale: int) -> Column:
    """Decimal rounded half up to ``scale``; NULL for bad text and for overflow."""
    return value.try_cast(f"decimal({precision},{scale})")


def whole_number(value: Column) -> Column:
    """Integer cast that rounds (half away from zero) instead of cutting the fraction off."""
    return F.round(value).cast("bigint")


def percentage(rate: Column) -> Column:
    return (rate * 100).cast("decimal(5,2)")


def percent_of(part: Column, total: Column) -> Column:
    """part / total in percent with two decimals; NULL when the total is zero."""
    return F.round(F.try_divide(part, total) * 100, 2)


def commission(premium: Column, rate: Column) -> Column:
    return F.round(premium * rate, 2)
