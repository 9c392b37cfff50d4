"""Daily broker commission files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake import schemas
from wanderlake.sources.tables import append_load

# Blanks around text belong to it; SILVER trims them.
AS_WRITTEN = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
DROP_NAME = r"broker_commissions_[^/]*\.csv"


def write_drop(df: DataFrame, folder: str, report_date: str, columns: Sequence[str] | None = None) -> str:
    """Write the broker rows of one day as a dated CSV drop with a header.

    ``columns`` gives their order where a receiver expects another one.
    """
    path = f"{folder}/broker_commissions_{report_date.replace('-', '_')}.csv"
    rows = df.select(*(columns or schemas.RAW_BROKER_COMMISSIONS))
    rows.write.mode("overwrite").options(header=True, **AS_WRITTEN).csv(path)
    return path


def newest_drop(spark: SparkSession, folder: str) -> str:
    """Path of the drop (a file, or a folder of part files) that was modified last.

    Only the file listing is read, not the files, and one row comes back.
    """
    try:
        # A drop is either a plain file or a folder, hence the second level.
        files = _listing(spark, f"{folder}/broker_commissions_*.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no broker commission file in {folder}") from error
    newest = files.orderBy(F.desc("modificationTime"), F.desc("drop")).first()
    if newest is None:
        raise FileNotFoundError(f"no broker commission file in {folder}")
    return newest["drop"]


def _listing(spark: SparkSession, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    drop = F.regexp_extract("path", f"^(.*/{DROP_NAME})(/.*)?$", 1)
    return files.select("modificationTime", drop.alias("drop"))


def read_drop(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a drop, columns found by their name in the header.

    The order of the columns is free, and further ones are left out; a missing one raises.
    Every part file of a drop has the header of the first. A value that does not fit its
    column's type is NULL.
    """
    text = spark.read.options(header=True, inferSchema=False, **AS_WRITTEN).csv(path)
    named = {c.strip().lower(): c for c in text.columns}
    missing = [c for c in schemas.RAW_BROKER_COMMISSIONS if c not in named]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return text.select(
        *(F.col(f"`{named[c]}`").try_cast(kind).alias(c) for c, kind in schemas.RAW_BROKER_COMMISSIONS.items())
    )


def load_newest_drop(spark: SparkSession, folder: str, bronze_path: str) -> tuple[str, int]:
    """Append the newest drop to BRONZE; gives its path and the number of rows loaded."""
    drop = newest_drop(spark, folder)
    load_id = drop.rsplit("/", 1)[-1].removesuffix(".csv")
    return drop, append_load(read_drop(spark, drop), bronze_path, load_id)
