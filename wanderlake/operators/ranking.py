"""Ordered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of a report; planned as one top-k, never a full sort."""
    return df.orderBy(*order).limit(n)
