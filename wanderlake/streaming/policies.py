"""Policy purchase events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderlake.fixed_values import RECENT_POLICY_HOURS, RECENT_POLICY_LIMIT
from wanderlake.functions.times import hours_before
from wanderlake.operators.ranking import top_rows
from wanderlake.session import remove, scratch_dir
from wanderlake.sources.messages import keyed_json, policy_records
from wanderlake.sources.tables import create_if_missing
from wanderlake.streaming.topics import write_message_files

SENT_SCHEMA = "policy_id bigint"


def recent_policies(
    policies: DataFrame,
    as_of: datetime,
    limit: int = RECENT_POLICY_LIMIT,
    hours: int = RECENT_POLICY_HOURS,
) -> DataFrame:
    """Report of the newest policies of the last hour; the id settles equal creation times."""
    recent = within_hours(policies, as_of, hours)
    return top_rows(recent, limit, F.desc_nulls_first("created_at"), F.col("policy_id"))


def within_hours(policies: DataFrame, as_of: datetime, hours: int = RECENT_POLICY_HOURS) -> DataFrame:
    """All policies of the last hours."""
    return policies.filter(F.col("created_at") >= hours_before(as_of, hours))


def unsent_policies(recent: DataFrame, sent: DataFrame) -> DataFrame:
    """Recent policies that are not in the sent log; NULL ids count as unsent."""
    return recent.join(sent.select("policy_id").distinct(), "policy_id", "left_anti")


def due_policies(recent: DataFrame, sent: DataFrame) -> tuple[DataFrame, bool]:
    """What to publish now, and whether the sent log starts again.

    When every recent policy was sent already, all of them are due again.
    """
    unsent = unsent_policies(recent, sent)
    if unsent.isEmpty():
        return recent, True
    return unsent, False


def policy_messages(policies: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return keyed_json(policy_records(policies, as_of), "policy_id")


def publish_due(
    policies: DataFrame,
    as_of: datetime,
    topic_path: str,
    sent_path: str,
    hours: int = RECENT_POLICY_HOURS,
) -> None:
    """Publish every due policy of the last hours as JSON lines, then note it in the sent log.

    The recent policies are stored once, so what is published and what is noted are the same
    rows, also of a source that changes meanwhile. A crash between the two writes publishes
    the same policies again: at least once.
    """
    spark = policies.sparkSession
    create_if_missing(spark, sent_path, SENT_SCHEMA)
    staging = scratch_dir(spark, "due-policies")
    within_hours(policies, as_of, hours).write.parquet(staging)
    due, again = due_policies(spark.read.parquet(staging), spark.read.parquet(sent_path))
    # The log is read before it is written, so what is due is stored as well.
    due.write.parquet(f"{staging}-now")
    due = spark.read.parquet(f"{staging}-now")
    write_message_files(policy_messages(due, as_of), topic_path)
    due.select("policy_id").write.mode("overwrite" if again else "append").parquet(sent_path)
    remove(spark, staging)
    remove(spark, f"{staging}-now")


def purchase_stream(policies: DataFrame, remember: str = "1 hour") -> DataFrame:
    """Streaming form: every new policy once within ``remember`` of its creation.

    The state holds the ids of that span only.
    """
    stamped = policies.withColumn("__created", F.col("created_at").cast("timestamp"))
    once = stamped.withWatermark("__created", remember).dropDuplicatesWithinWatermark(["policy_id"])
    return policy_messages(once.drop("__created"))
