"""Quality checks of the stored facts that scan only what changed since the last report.

A fact consists of key ranges, and its manifest names the files of each. What the checks find
in a range depends on those files alone, so it is stored under the range's state (its versions)
and used again as long as the manifest names the same state:

* row-level checks: the number of failing rows;
* uniqueness of the fact's key: the number of repeated values. Ranges never share a key, so these
  numbers add up;
* relationships: the keys without a parent, with their rows. An upsert never removes a key, so a
  key that has a parent keeps it, and only the stored orphans are looked up again, in the ranges
  of the parents' table that they name.

A report therefore reads the rewritten ranges once, and small tables of one row for each range
and check. The whole of these is stored anew by each report that scans something, under the next
number; a folder counts once Spark has marked it as complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.operators.lookup import missing_parents
from wanderlake.operators.upsert import RANGE, KEYS_PER_RANGE, Manifest, range_of, read_keyed, read_manifest, read_ranges, state_of
from wanderlake.plans import quality, star
from wanderlake.session import children, remove

STATE = "state"
FOUND = f"{STATE} string, check_name string, column_name string, failures bigint"
ORPHANS = f"{STATE} string, column_name string, parent_key bigint, row_count bigint"
_KEYS = {"fact_policies": "policy_id", "fact_claims": "claim_id"}


def gold_report(spark: SparkSession, root: str) -> DataFrame:
    """The declared tests of the stored star schema, equal to ``quality.gold_report``.

    Dimensions are rebuilt by every run and tested whole; they are small beside the facts.
    """
    gold = {name: star.read_gold_table(spark, root, name) for name in star.DIMENSIONS}
    reports = [quality.dimension_report(gold)]
    for name, checks in quality.fact_checks(star.read_gold_table(spark, root, "fact_policies")).items():
        reports.append(fact_report(spark, root, name, _KEYS[name], checks, f"{root}/fact_policies"))
    return reduce(DataFrame.unionByName, reports)


def fact_report(
    spark: SparkSession,
    root: str,
    name: str,
    key: str,
    checks: Sequence,
    parents_path: str,
    keys_per_parent_range: int = KEYS_PER_RANGE,
) -> DataFrame:
    """Check the ranges of a keyed table that changed, and report all of them.

    ``Unique`` may be asked of ``key`` only. The parents of a ``Relationship`` are read from the
    keyed table at ``parents_path``. An empty table passes every check.
    """
    wrong = [c.column for c in checks if isinstance(c, quality.Unique) and c.column != key]
    if wrong:
        raise ValueError(f"ranges of {key} say nothing about the uniqueness of {', '.join(wrong)}")
    store = f"{root}/checks/{name}"
    _, entries = read_manifest(spark, f"{root}/{name}")
    states = {state_of(r, e): r for r, e in entries.items()}
    current = spark.createDataFrame([(s,) for s in states], f"{STATE} string")
    found, orphans = _stored(spark, store)
    # At most one row for each range of the manifest.
    known = {r[STATE] for r in current.join(found.select(STATE).distinct(), STATE, "left_semi").collect()}
    fresh: Manifest = {r: entries[r] for s, r in states.items() if s not in known}
    if fresh:
        rows = rows_by_state(spark, f"{root}/{name}", fresh)
        kept = [part.join(current, STATE, "left_semi") for part in (found, orphans)]
        _store(spark, store, kept, _scan(rows, key, checks), _orphans(rows, checks, parents_path, keys_per_parent_range))
        found, orphans = _stored(spark, store)
    totals = found.join(current, STATE, "left_semi").select("check_name", "column_name", "failures")
    for check in checks:
        if isinstance(check, quality.Relationship):
            own = orphans.join(current, STATE, "left_semi").filter(F.col("column_name") == check.column)
            parents = read_keyed(spark, parents_path, own.select(range_of(F.col("parent_key"), keys_per_parent_range)))
            left = own if parents is None else own.join(parents, F.col("parent_key") == F.col(check.parent_column), "left_anti")
            totals = totals.unionByName(_line(left, check, "row_count"))
    asked = spark.createDataFrame([(i, c.name, c.column) for i, c in enumerate(checks)], "place int, check_name string, column_name string")
    summed = totals.groupBy("check_name", "column_name").agg(F.sum("failures").alias("failures"))
    lines = F.broadcast(asked).join(summed, ["check_name", "column_name"], "left")
    lines = lines.withColumn("failures", F.coalesce("failures", F.lit(0).cast("bigint")))
    return lines.select(F.lit(name).alias("table_name"), "check_name", "column_name", "failures", quality.status())


def rows_by_state(spark: SparkSession, path: str, entries: Manifest) -> DataFrame:
    """Rows of the given ranges with the state of their range."""
    names = spark.createDataFrame([(r, state_of(r, e)) for r, e in entries.items()], f"__range bigint, {STATE} string")
    rows = read_ranges(spark, path, entries)
    return rows.join(F.broadcast(names), F.col(RANGE).eqNullSafe(F.col("__range"))).drop("__range", RANGE)


def _scan(rows: DataFrame, key: str, checks: Sequence) -> DataFrame:
    """Failures of every check that needs no other table, for each state."""
    row_level = [c for c in checks if hasattr(c, "failing")]
    counts = rows.groupBy(STATE).agg(
        F.lit(0).cast("bigint").alias("seen"), *[F.count_if(c.failing()).alias(f"c{i}") for i, c in enumerate(row_level)]
    )
    # A range is known as scanned even if the table has no row-level check.
    named = [("seen", "scan", key), *[(f"c{i}", c.name, c.column) for i, c in enumerate(row_level)]]
    lines = F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.lit(c).alias("column_name"), F.col(source).alias("failures"))
        for source, n, c in named
    ])
    reports = [counts.select(STATE, F.inline(lines))]
    for check in checks:
        if isinstance(check, quality.Unique):
            repeated = rows.filter(F.col(key).isNotNull()).groupBy(STATE, key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            failures = repeated.groupBy(STATE).agg(F.count(F.lit(1)).alias("failures"))
            reports.append(failures.select(STATE, F.lit(check.name).alias("check_name"), F.lit(check.column).alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, reports)


def _orphans(rows: DataFrame, checks: Sequence, parents_path: str, keys_per_range: int) -> DataFrame:
    """Keys without a parent in each state, looked up in the ranges that they name."""
    spark, reports = rows.sparkSession, [rows.sparkSession.createDataFrame([], ORPHANS)]
    for check in checks:
        if isinstance(check, quality.Relationship):
            asked = rows.filter(F.col(check.column).isNotNull())
            named = asked.select(range_of(F.col(check.column), keys_per_range))
            parents = read_keyed(spark, parents_path, named)
            counted = asked.groupBy(STATE, check.column).agg(F.count(F.lit(1)).alias("row_count"))
            if parents is not None:
                known = parents.select(F.col(check.parent_column).alias("__parent"))
                counted = counted.join(known, F.col(check.column) == F.col("__parent"), "left_anti")
            reports.append(counted.select(STATE, F.lit(check.column).alias("column_name"), F.col(check.column).cast("bigint").alias("parent_key"), "row_count"))
    return reduce(DataFrame.unionByName, reports)


def _line(rows: DataFrame, check, column: str) -> DataFrame:
    total = rows.agg(F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias("failures"))
    return total.select(F.lit(check.name).alias("check_name"), F.lit(check.column).alias("column_name"), "failures")


def _complete(spark: SparkSession, store: str) -> list[str]:
    """Stored runs, oldest first; one that was cut short is left out."""
    runs = sorted(n for n in children(spark, store) if n.startswith("run-"))
    return [n for n in runs if "_SUCCESS" in children(spark, f"{store}/{n}/orphans")]


def _stored(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    runs = _complete(spark, store)
    if not runs:
        return spark.createDataFrame([], FOUND), spark.createDataFrame([], ORPHANS)
    return (
        spark.read.schema(FOUND).parquet(f"{store}/{runs[-1]}/found"),
        spark.read.schema(ORPHANS).parquet(f"{store}/{runs[-1]}/orphans"),
    )


def _store(spark: SparkSession, store: str, kept: Sequence[DataFrame], found: DataFrame, orphans: DataFrame) -> None:
    """Write the findings that are still current and the new ones as the next run.

    The run before stays for those who read it; older ones are removed.
    """
    runs = _complete(spark, store)
    number = int(runs[-1].split("-")[1]) + 1 if runs else 1
    path = f"{store}/run-{number:09d}-{uuid.uuid4().hex}"
    for name, old, new in zip(("found", "orphans"), kept, (found, orphans), strict=True):
        old.unionByName(new).write.parquet(f"{path}/{name}")
    for name in runs[:-1]:
        remove(spark, f"{store}/{name}")
