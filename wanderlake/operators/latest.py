"""Keep the latest row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    by: Sequence[str],
    unknown_first: bool = False,
) -> DataFrame:
    """Row with the largest ``by`` columns per key; NULL keys form one group.

    ``unknown_first`` lets a row without a ``by`` value win. Ties are settled by the
    remaining columns (largest first), so the survivor never depends on how rows were
    partitioned. Spark cuts each key down to one row in every input task before the shuffle
    (WindowGroupLimit), so a key that holds a large share of the rows reaches its reducer as
    at most one row per task.
    """
    lead = [F.col(n).desc_nulls_first() if unknown_first else F.col(n).desc_nulls_last() for n in by]
    rest = [F.col(n).desc_nulls_last() for n in df.columns if n not in by and n not in keys_named(keys)]
    window = Window.partitionBy(*keys).orderBy(*lead, *rest)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def keys_named(keys: Sequence[str | Column]) -> list[str]:
    return [key for key in keys if isinstance(key, str)]


def latest_per_window(
    df: DataFrame, keys: Sequence[str], time_column: str, width: str, delay: str
) -> DataFrame:
    """Streaming form: latest row per key and event-time window.

    A window's row is emitted once the watermark has passed it. The row is the maximum of
    (time, remaining columns), the same choice as ``latest_per_key``; the partial maximum
    runs before the shuffle and the state holds one row per open key and window.
    """
    stamped = df.withColumn("__event_time", F.col(time_column).cast("timestamp"))
    first = [*keys, time_column]
    rest = [c for c in df.columns if c not in first]
    latest = (
        stamped.withWatermark("__event_time", delay)
        .groupBy(*keys, F.window("__event_time", width).alias("__window"))
        .agg(F.max(F.struct(time_column, *rest)).alias("__latest"))
    )
    picked = [F.col(c) if c in keys else F.col(f"__latest.{c}").alias(c) for c in df.columns]
    return latest.select(*picked)
