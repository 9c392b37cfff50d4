"""Freshness gate, stream lag, landing freshness and run status."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.fixed_values import GATE_HOURS, LAG_ALERT, LANDING_MINUTES
from wanderlake.functions.times import hours_before, minutes_before

STATUS_SCHEMA = "step string, state string, detail string"


def source_activity(
    policies: DataFrame, claims: DataFrame, as_of: datetime, hours: int = GATE_HOURS
) -> DataFrame:
    """Policies and claims created in the last hours, and whether a run is worth it."""

    since = F.col("created_at") >= hours_before(as_of, hours)

    def recent(df: DataFrame, policies_side: int) -> DataFrame:
        n = F.count(F.lit(1))
        return df.filter(since).agg(
            (n * policies_side).alias("policies_count"), (n * (1 - policies_side)).alias("claims_count")
        )

    counts = (
        recent(policies, 1)
        .unionByName(recent(claims, 0))
        .agg(F.sum("policies_count").alias("policies_count"), F.sum("claims_count").alias("claims_count"))
    )
    return counts.withColumn(
        "should_run", (F.col("policies_count") > 0) | (F.col("claims_count") > 0)
    )


def partition_lag(offsets: DataFrame) -> DataFrame:
    """Messages waiting per partition; without a committed offset all kept ones are waiting."""
    committed = F.when(F.col("committed") < 0, F.col("low")).otherwise(F.col("committed"))
    lag = F.greatest(F.col("high") - committed, F.lit(0))
    return offsets.select("partition", lag.cast("bigint").alias("lag"))


def stream_lag(offsets: DataFrame, alert: int = LAG_ALERT) -> DataFrame:
    total = partition_lag(offsets).agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))
    return total.withColumn(
        "status", F.when(F.col("total_lag") > alert, "high").otherwise("healthy")
    )


def landing_freshness(
    raw_flights: DataFrame, as_of: datetime, minutes: int = LANDING_MINUTES
) -> DataFrame:
    """Rows that landed in the last minutes; none is a warning."""
    recent = raw_flights.filter(F.col("ingested_at") >= minutes_before(as_of, minutes))
    return recent.agg(F.count(F.lit(1)).alias("recent_rows")).withColumn(
        "status", F.when(F.col("recent_rows") == 0, "warning").otherwise("healthy")
    )


def run_status(spark: SparkSession, steps: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per step of a run: success, failed, upstream_failed or skipped."""
    return spark.createDataFrame(list(steps), STATUS_SCHEMA)


def status_summary(steps: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("state") == "failed")
    blocked = F.count_if(F.col("state") == "upstream_failed")
    return steps.agg(
        failed.alias("failed_steps"),
        blocked.alias("upstream_failed_steps"),
        (failed + blocked == 0).alias("succeeded"),
    )
