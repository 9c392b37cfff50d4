"""Flight event streams."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wanderlake import schemas
from wanderlake.fixed_values import CLEANING_TRUE_TEXT
from wanderlake.functions.text import is_true_text
from wanderlake.functions.times import moment, utc_now
from wanderlake.operators.latest import latest_per_window
from wanderlake.session import children
from wanderlake.sources.messages import decode_flights, flight_states, keyed_json, normalise_states

OUTCOME = "outcome"
LANDED_DAY = "landed_day"
SINK_SCHEMA = schemas.ddl({**schemas.RAW_FLIGHTS, "raw_value": "string", OUTCOME: "string", LANDED_DAY: "date"})


def start_ingest(
    messages: DataFrame,
    table_path: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    every: str | None = None,
    keep: str | None = None,
) -> StreamingQuery:
    """Land a stream of (key, value) messages in BRONZE.

    One pass decodes each message and writes it under ``outcome=accepted`` or
    ``outcome=rejected`` and the day it landed, so incremental readers list and read only the
    days since their mark. The file sink's log makes every micro-batch visible exactly once,
    and only then is its offset committed; a restart resumes from the checkpoint. Without
    ``every`` the query drains what is there and ends.

    ``keep`` (such as "30d") lets the sink's log forget older files, so that readers do not
    load an entry for every file ever landed; copy their days with ``compact_days`` before, and
    give the archive to the readers.
    """
    stamp = utc_now() if ingested_at is None else ingested_at
    decoded = decode_flights(messages, stamp)
    landed = decoded.select(
        *schemas.RAW_FLIGHTS,
        F.to_date(stamp).alias(LANDED_DAY),
        F.when(~F.col("accepted"), F.col("raw_value")).alias("raw_value"),
        F.when(F.col("accepted"), "accepted").otherwise("rejected").alias(OUTCOME),
    )
    writer = landed.writeStream.partitionBy(OUTCOME, LANDED_DAY)
    if keep:
        writer = writer.option("retention", keep)
    return _start(writer, table_path, checkpoint, every)


def landed(spark: SparkSession, table_path: str, archive_path: str | None = None) -> DataFrame:
    """All landed messages; with an archive, every landed day comes from exactly one of both.

    A day that was archived is read from the archive, whether the live table still knows all,
    some or none of its files. The archived days are known from the folder listing alone.
    """
    live = spark.read.schema(SINK_SCHEMA).parquet(table_path)
    days = archived_days(spark, archive_path) if archive_path else []
    if not days:
        return live
    archived = spark.read.schema(SINK_SCHEMA).parquet(archive_path)
    return live.filter(~F.col(LANDED_DAY).isin(days)).unionByName(archived)


def archived_days(spark: SparkSession, archive_path: str) -> list[date]:
    """Landed days that ``compact_days`` has copied."""
    names = {n for outcome in children(spark, archive_path) for n in children(spark, f"{archive_path}/{outcome}")}
    return sorted(date.fromisoformat(n.split("=")[1]) for n in names if n.startswith(f"{LANDED_DAY}="))


def landed_flights(
    spark: SparkSession, table_path: str, since: datetime | None = None, archive_path: str | None = None
) -> DataFrame:
    """RAW_FLIGHTS as landed so far, or since a time; rejects and earlier days are pruned."""
    rows = landed(spark, table_path, archive_path).filter(F.col(OUTCOME) == "accepted")
    if since is not None:
        rows = rows.filter((F.col(LANDED_DAY) >= F.lit(since.date())) & (F.col("ingested_at") >= moment(since)))
    return rows.select(*schemas.RAW_FLIGHTS)


def compact_days(spark: SparkSession, table_path: str, before: datetime, archive_path: str) -> None:
    """Copy the landed days before a time into few large files of an archive with the same layout.

    A day is copied once: later the live table may have forgotten some of its files. Days that
    are over get no more rows, and a run that was cut short has copied none.
    """
    done = archived_days(spark, archive_path)
    rows = spark.read.schema(SINK_SCHEMA).parquet(table_path).filter(F.col(LANDED_DAY) < F.lit(before.date()))
    rows = rows.filter(~F.col(LANDED_DAY).isin(done)).hint("rebalance", OUTCOME, LANDED_DAY)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(OUTCOME, LANDED_DAY).parquet(archive_path)


def landed_rejects(spark: SparkSession, table_path: str, archive_path: str | None = None) -> DataFrame:
    rows = landed(spark, table_path, archive_path)
    return rows.filter(F.col(OUTCOME) == "rejected").select("raw_value")


def deduplicate(flights: DataFrame, width: str = "30 seconds", delay: str = "10 minutes") -> DataFrame:
    """Streaming form of the flight cleaning: latest event per aircraft and time bucket.

    The position test again follows the choice of the latest event. An event without a time
    belongs to no window; the batch job covers those.
    """
    latest = latest_per_window(flights, ["icao24"], "event_timestamp", width, delay)
    return latest.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).withColumn(
        "on_ground", is_true_text(F.col("on_ground"), CLEANING_TRUE_TEXT, ignore_case=True)
    )


def state_messages(responses: DataFrame, as_of=None) -> DataFrame:
    """API responses (streaming or not) to keyed flight messages."""
    return keyed_json(normalise_states(flight_states(responses), as_of), "icao24")


def start_sink(
    df: DataFrame, table_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once per micro-batch."""
    return _start(df.writeStream, table_path, checkpoint, every)


def _start(writer, path: str, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if every:
        writer = writer.trigger(processingTime=every)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
