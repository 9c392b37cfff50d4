"""Table scans and table writes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.functions.text import upper_names
from wanderlake.session import children

LOAD = "load_id"


def read_table(
    spark: SparkSession, name: str, source: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Scan a table by path (file sources) or by ``dbtable`` (connectors such as jdbc)."""
    reader = spark.read.format(source).options(**(options or {}))
    if source in ("parquet", "orc", "csv", "json"):
        return reader.load(name)
    return reader.option("dbtable", name).load()


def write_table(
    df: DataFrame, name: str, source: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Replace a table with the rows of ``df``."""
    writer = df.write.format(source).options(**(options or {})).mode("overwrite")
    if source in ("parquet", "orc", "csv", "json"):
        writer.save(name)
    else:
        writer.option("dbtable", name).save()


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when no row was stored there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def create_if_missing(spark: SparkSession, path: str, schema: str) -> None:
    """Give a table its fixed schema before its first load; an existing table is untouched."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append_load(df: DataFrame, path: str, load_id: str) -> int:
    """Append one load under upper-case names and return its row count.

    Every load owns a folder, so a repeated load replaces itself instead of duplicating its
    rows. The count comes from the footers of the files just written, which stays exact when
    tasks were retried. An empty load writes nothing.
    """
    if df.isEmpty():
        return 0
    target = f"{path}/{LOAD}={load_id}"
    upper_names(df).write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target).count()


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """All loads of an append-only table, with the columns of every load; NULL where one had none."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(LOAD)


def loads_after(spark: SparkSession, path: str, load_id: str = "") -> tuple[DataFrame | None, str]:
    """The loads that came after one, and the newest load's id; only their folders are listed and read.

    Load ids are compared as text, as the extracts' times sort.
    """
    ids = sorted(n.split("=", 1)[1] for n in children(spark, path) if n.startswith(f"{LOAD}="))
    new = [i for i in ids if i > load_id]
    if not new:
        return None, load_id
    read = spark.read.option("mergeSchema", True).option("basePath", path)
    return read.parquet(*(f"{path}/{LOAD}={i}" for i in new)).drop(LOAD), new[-1]


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, by table name."""
    counted = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted.orderBy("table_name")


def run_query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Ad-hoc SQL over named tables; a faulty query raises."""
    return spark.sql(text, **tables)
