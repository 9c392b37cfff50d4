"""BRONZE cleaning jobs and flight statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.fixed_values import CLEANING_TRUE_TEXT, DEDUP_SECONDS
from wanderlake.functions.numbers import decimal_or_null
from wanderlake.functions.text import is_true_text, trim_strings
from wanderlake.functions.times import bucket_number, moment, utc_now
from wanderlake.operators.latest import latest_per_key
from wanderlake.session import remove, scratch_dir
from wanderlake.sources.extract import load_state, save_state

DAY = "event_day"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
CLEAN_FLIGHTS = "flights_clean"
FLIGHT_STATS = "flight_daily_stats"


def clean_flights(
    raw: DataFrame, as_of: datetime | None = None, seconds: int = DEDUP_SECONDS
) -> DataFrame:
    """Latest event per aircraft and time bucket, with a position and a boolean ground flag.

    The position test comes after the choice of the latest event: a bucket whose newest
    event has no position is gone, not replaced by an older event.
    """
    latest = latest_per_key(
        raw,
        ["icao24", bucket_number(F.col("event_timestamp"), seconds)],
        ["event_timestamp"],
    )
    stamp = utc_now() if as_of is None else moment(as_of)
    return latest.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).withColumns(
        {
            "on_ground": is_true_text(F.col("on_ground"), CLEANING_TRUE_TEXT, ignore_case=True),
            "ingested_at": stamp,
        }
    )


def clean_policies(raw: DataFrame) -> DataFrame:
    """Latest row per policy number, strings trimmed, premium as decimal(10,2)."""
    latest = latest_per_key(raw, ["policy_number"], ["created_at"])
    return trim_strings(latest).withColumn(
        "premium_amount", decimal_or_null(F.col("premium_amount"), 10, 2)
    )


def flight_daily_stats(clean: DataFrame) -> DataFrame:
    """Flights per day and origin country.

    The rows carry no order: a sort before an overwrite would cost a second shuffle and is
    not kept by the table. Readers order the few rows they show.
    """
    return clean.groupBy(F.to_date("event_timestamp").alias("flight_day"), "origin_country").agg(
        F.count(F.lit(1)).alias("flight_count"),
        F.avg("altitude").alias("avg_altitude"),
        F.avg("velocity").alias("avg_velocity"),
        (F.avg(F.col("on_ground").cast("int")) * 100).alias("pct_on_ground"),
    )


def refresh_flights(
    raw: DataFrame,
    root: str,
    as_of: datetime,
    overlap: timedelta = timedelta(hours=1),
    landed_since: Callable[[datetime], DataFrame] | None = None,
) -> None:
    """Bring the stored clean flights and their statistics up to date, day by day.

    A bucket never crosses midnight and the statistics are per day, so only days with rows
    that landed since the last finished run are computed again, however many they are; their
    partitions are swapped in at commit, and those of days left without a row are deleted.
    All other days keep their rows and stamps. ``overlap`` covers rows that became visible
    late; a repeated day gives the same rows. The first run covers all days. A run is noted
    once both tables are written, so one that was cut short is repeated.

    ``landed_since`` reads the rows landed since a time, where the landing table can prune
    for it; without it ``raw`` is filtered. Times are UTC, as the landing stamps are.
    """
    spark = raw.sparkSession
    flights_path, stats_path = f"{root}/{CLEAN_FLIGHTS}", f"{root}/{FLIGHT_STATS}"
    marks = f"{root}/flight_marks"
    last = load_state(spark, marks).get(CLEAN_FLIGHTS)
    whole = _by_day(clean_flights(raw, as_of))
    if last is None:
        _swap_days(whole, flights_path, "static")
        stored = spark.read.schema(whole.schema).parquet(flights_path)
        _swap_days(_stats_by_day(stored), stats_path, "static")
    else:
        since = last - overlap
        landed = landed_since(since) if landed_since else raw
        landed = landed.filter(F.col("ingested_at") >= moment(since))
        staging = scratch_dir(spark, "flight-days")
        landed.select(F.to_date("event_timestamp").alias(DAY)).distinct().write.parquet(staging)
        days = spark.read.parquet(staging)
        part = _by_day(clean_flights(_on_days(raw, F.to_date("event_timestamp"), days), as_of))
        _swap_days(part, flights_path, "dynamic")
        stored = _on_days(spark.read.schema(whole.schema).parquet(flights_path), F.col(DAY), days)
        # A touched partition with another stamp was not swapped: its day has no row any more.
        stale = stored.filter(~F.col("ingested_at").eqNullSafe(moment(as_of))).select(DAY).distinct()
        for row in stale.collect():  # no more than the table has partitions
            name = f"{DAY}={NO_DAY if row[DAY] is None else row[DAY]}"
            remove(spark, f"{flights_path}/{name}")
            remove(spark, f"{stats_path}/{name}")
        spark.catalog.refreshByPath(flights_path)
        stored = _on_days(spark.read.schema(whole.schema).parquet(flights_path), F.col(DAY), days)
        _swap_days(_stats_by_day(stored), stats_path, "dynamic")
        remove(spark, staging)
    save_state(spark, marks, {CLEAN_FLIGHTS: as_of})


def read_clean_flights(raw: DataFrame, root: str) -> DataFrame:
    """The stored clean flights with the columns of the raw ones."""
    columns = clean_flights(raw).schema
    stored = raw.sparkSession.read.schema(columns).parquet(f"{root}/{CLEAN_FLIGHTS}")
    return stored.select(*columns.names)


def read_flight_stats(spark: SparkSession, root: str) -> DataFrame:
    """The stored flight statistics, their day as an ordinary column."""
    columns = (
        f"{DAY} date, origin_country string, flight_count bigint, avg_altitude double, "
        "avg_velocity double, pct_on_ground double"
    )
    stored = spark.read.schema(columns).parquet(f"{root}/{FLIGHT_STATS}")
    stored = stored.withColumnRenamed(DAY, "flight_day")
    return stored.select(
        "flight_day", "origin_country", "flight_count", "avg_altitude", "avg_velocity", "pct_on_ground"
    )


def _on_days(df: DataFrame, day: Column, days: DataFrame) -> DataFrame:
    """Rows of the listed days (an unknown day counts as one).

    The lowest and highest day come to the driver as literal bounds, which prune partitions and
    row groups; the exact days are matched by a join, so no list of them is collected.
    """
    bounds = days.agg(F.min(DAY).alias("low"), F.max(DAY).alias("high")).first()
    inside = day.isNull()
    if bounds["low"] is not None:
        inside = inside | day.between(F.lit(bounds["low"]), F.lit(bounds["high"]))
    wanted = days.select(F.col(DAY).alias("__day"))
    return df.filter(inside).join(wanted, day.eqNullSafe(F.col("__day")), "left_semi")


def _by_day(clean: DataFrame) -> DataFrame:
    """Rows gathered by day; a day larger than the advisory size is split over tasks."""
    return clean.withColumn(DAY, F.to_date("event_timestamp")).hint("rebalance", DAY)


def _stats_by_day(clean: DataFrame) -> DataFrame:
    return flight_daily_stats(clean).withColumnRenamed("flight_day", DAY)


def _swap_days(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(DAY).parquet(path)


def flight_daily_report(stats: DataFrame) -> DataFrame:
    return stats.orderBy("flight_day", "origin_country")


def removal_report(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows before, after and removed per table, from (raw, clean) pairs.

    Give it stored tables: their row counts come from file footers and stay exact when
    tasks of the cleaning job were retried.
    """
    counts = None
    for name, (raw, clean) in pairs.items():
        for df, side in ((raw, 1), (clean, 0)):
            one = df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("table_name"),
                (F.col("n") * side).alias("before"),
                (F.col("n") * (1 - side)).alias("after"),
            )
            counts = one if counts is None else counts.unionByName(one)
    return (
        counts.groupBy("table_name")
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
        .withColumn("removed", F.col("before") - F.col("after"))
    )
