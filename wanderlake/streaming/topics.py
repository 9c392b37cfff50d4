"""Message topics: Kafka where its package is installed, else folders of message files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

FLIGHT_TOPIC = "flight-events"
POLICY_TOPIC = "policy-events"


def read_topic(
    spark: SparkSession,
    topic: str,
    options: Mapping[str, str],
    max_per_batch: int | None = None,
) -> DataFrame:
    """(key, value) stream of a topic, from its earliest offset when there is no checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .options(**options)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().select("key", "value")


def write_topic(messages: DataFrame, topic: str, options: Mapping[str, str]) -> None:
    """Publish a batch of (key, value) messages."""
    messages.write.format("kafka").options(**options).option("topic", topic).save()


def start_topic(
    messages: DataFrame, topic: str, options: Mapping[str, str], checkpoint: str
) -> StreamingQuery:
    """Publish a stream of (key, value) messages: at least once per micro-batch."""
    return (
        messages.writeStream.format("kafka")
        .options(**options)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def read_message_files(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None
) -> DataFrame:
    """(key, value) stream of the message files in a folder, oldest first."""
    reader = spark.readStream.schema("key string, value string")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(path)


def write_message_files(messages: DataFrame, path: str) -> None:
    """Add a batch of (key, value) messages to a folder, one JSON line each."""
    messages.select("key", "value").write.mode("append").json(path)
