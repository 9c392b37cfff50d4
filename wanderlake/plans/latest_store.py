"""Stored latest rows of RAW tables, brought up to date by what was loaded since.

For every RAW table there is a keyed table with the latest row of each key, as loaded. A run
reads only the loads that came after the last merged one, reduces them to one row for each
key, and merges that with the stored rows of the same keys: the latest of both stays. As the
order of a key's rows is total, this gives the same rows as a deduplication of all loads.
Standardised SILVER tables are projections of it, without a shuffle. Narrow ranges are widened as a
table gets many of them, so its files grow with its rows instead of becoming many small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.operators.latest import latest_per_key
from wanderlake.operators.upsert import KEYS_PER_RANGE, MOST_RANGES, RANGE, read_keyed, upsert
from wanderlake.plans import silver
from wanderlake.sources.tables import loads_after, stored_table

KEYS = {"raw_customers": "customer_id", "raw_policies": "policy_id", "raw_claims": "claim_id"}
STANDARD = {
    "raw_customers": silver.standard_customers,
    "raw_policies": silver.standard_policies,
    "raw_claims": silver.standard_claims,
}


def merge_latest(rows: DataFrame, path: str, key: str, keys_per_range: int = KEYS_PER_RANGE) -> None:
    """Merge new RAW rows into the table of latest rows; merging rows again changes nothing."""

    def choose(both: DataFrame) -> DataFrame:
        # A range follows from the key, and stored and new rows already lie by range.
        return latest_per_key(both, [RANGE, key], ["created_at"], unknown_first=True)

    latest = silver.latest_rows(rows, key)
    upsert(
        latest, path, key, keys_per_range, known_unique=True, match_null=True, choose=choose, most_ranges=MOST_RANGES, keys=rows
    )


def refresh(spark: SparkSession, loads: str, root: str, name: str, keys_per_range: int = KEYS_PER_RANGE) -> int:
    """Merge the loads of a RAW table that came since the last refresh; returns how many there were before it.

    The newest merged load is noted after the merge, so a run that was cut short is repeated.
    """
    path, marks = f"{root}/latest/{name}", f"{root}/latest/marks/{name}"
    noted = stored_table(spark, marks)
    runs = [] if noted is None else [r["load_id"] for r in noted.select("load_id").collect()]
    rows, newest = loads_after(spark, loads, max(runs, default=""))
    if rows is not None:
        rows = rows.toDF(*[c.lower() for c in rows.columns])
        merge_latest(rows, path, KEYS[name], keys_per_range)
        done = spark.createDataFrame([(newest,)], "load_id string").coalesce(1)
        done.write.mode("append").parquet(marks)
    return len(runs)


def latest(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The stored latest rows in their RAW form; None before the first load."""
    return read_keyed(spark, f"{root}/latest/{name}")


def standardised(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The SILVER form of the stored latest rows."""
    rows = latest(spark, root, name)
    return None if rows is None else STANDARD[name](rows)
