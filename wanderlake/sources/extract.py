"""Incremental batch extract from the operational tables into BRONZE."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.fixed_values import EXTRACT_TARGETS
from wanderlake.functions.times import moment
from wanderlake.sources.tables import append_load

STATE_SCHEMA = "source_table string, last_extracted_at timestamp_ntz"
SUMMARY_SCHEMA = "source_table string, extracted bigint, loaded bigint"


def extract(source: DataFrame, since: datetime | None) -> DataFrame:
    """All rows at first; later the rows created strictly after the last mark.

    The mark is a literal, so the filter is pushed into a parquet or JDBC scan.
    """
    return source if since is None else source.filter(F.col("created_at") > moment(since))


def load_state(spark: SparkSession, path: str) -> dict[str, datetime]:
    """Last extract time per source table (one entry per table of the mapping)."""
    try:
        log = spark.read.schema(STATE_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    marks = log.groupBy("source_table").agg(F.max("last_extracted_at").alias("mark"))
    return {row["source_table"]: row["mark"] for row in marks.collect()}


def save_state(spark: SparkSession, path: str, marks: Mapping[str, datetime]) -> None:
    """Add the marks of a finished run; earlier marks stay, so a failed write loses nothing."""
    entries = [
        F.struct(F.lit(name).alias("source_table"), moment(mark).alias("last_extracted_at"))
        for name, mark in marks.items()
    ]
    rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))
    rows.write.mode("append").json(path)


def run_extract(
    sources: Mapping[str, DataFrame],
    bronze_root: str,
    state_path: str,
    started_at: datetime,
    targets: Mapping[str, str] = EXTRACT_TARGETS,
) -> DataFrame:
    """Extract every mapped table and return (source_table, extracted, loaded).

    All tables get the run's start time as their mark, and only after every append is done:
    rows created during the run are read again next time, and a failed run is repeated.
    """
    spark = next(iter(sources.values())).sparkSession
    marks = load_state(spark, state_path)
    load_id = started_at.strftime("%Y%m%dT%H%M%S%f")
    summary = []
    for source_table, target in targets.items():
        rows = extract(sources[source_table], marks.get(source_table))
        loaded = append_load(rows, f"{bronze_root}/{target}", load_id)
        summary.append((source_table, loaded, loaded))
    save_state(spark, state_path, {name: started_at for name in targets})
    return spark.createDataFrame(summary, SUMMARY_SCHEMA)
