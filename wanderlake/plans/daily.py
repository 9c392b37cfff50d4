"""The daily run: the jobs in order, over tables below one root folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from wanderlake import schemas
from wanderlake.plans import bronze, check_store, latest_store, monitor, reconcile, star
from wanderlake.sources.broker_files import load_newest_drop
from wanderlake.sources.extract import run_extract
from wanderlake.sources.tables import create_if_missing, read_loads, write_table
from wanderlake.streaming.flights import landed_flights


class NothingToDo(Exception):
    """Neither policies nor claims changed lately."""


def run_daily(
    sources: Mapping[str, DataFrame],
    drop_folder: str,
    landing: str,
    root: str,
    as_of: datetime,
    landing_archive: str | None = None,
) -> DataFrame:
    """Run every step and return their states; the same rows are stored under ``root``.

    A failed step blocks the steps after it, and an idle source skips them; reconciliation
    and the status report run in any case. ``landing_archive`` has the landed days that
    ``compact_days`` copied, where the landing table forgets old files.
    """
    spark = next(iter(sources.values())).sparkSession
    steps: list[tuple[str, Callable[[], str], bool]] = [
        ("check_source_activity", lambda: _gate(sources, as_of), False),
        ("extract_sources", lambda: _extract(sources, root, as_of), False),
        ("load_broker_file", lambda: _load_brokers(spark, drop_folder, root), False),
        ("clean_bronze", lambda: _clean(spark, landing, root, as_of, landing_archive), False),
        ("build_gold", lambda: _gold(spark, root, as_of), False),
        ("check_quality", lambda: _quality(spark, root), False),
        ("reconcile", lambda: _reconcile(spark, sources, root), True),
    ]
    states = []
    stopped = ""
    for name, action, always in steps:
        if stopped and not always:
            states.append((name, stopped, ""))
            continue
        try:
            states.append((name, "success", action()))
        except NothingToDo as reason:
            states.append((name, "skipped", str(reason)))
            stopped = "skipped"
        except Exception as error:  # noqa: BLE001 - the state of every step is reported
            states.append((name, "failed", str(error).splitlines()[0] if str(error) else repr(error)))
            stopped = stopped or "upstream_failed"
    status = monitor.run_status(spark, states)
    status.write.mode("overwrite").json(f"{root}/reports/status_{as_of:%Y%m%d_%H%M%S}")
    return status


def read_bronze(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The loaded BRONZE tables under lower-case column names."""
    names = ("raw_customers", "raw_policies", "raw_claims", "raw_broker_commissions")
    return {name: lower_names(read_loads(spark, f"{root}/bronze/{name}")) for name in names}


def _gate(sources: Mapping[str, DataFrame], as_of: datetime) -> str:
    row = monitor.source_activity(sources["policies"], sources["claims"], as_of).first()
    if not row["should_run"]:
        raise NothingToDo("no policies and no claims in the last 24 hours")
    return f"policies={row['policies_count']} claims={row['claims_count']}"


def _extract(sources: Mapping[str, DataFrame], root: str, as_of: datetime) -> str:
    summary = run_extract(sources, f"{root}/bronze", f"{root}/state/extract", as_of)
    return " ".join(f"{row['source_table']}={row['loaded']}" for row in summary.collect())


def _load_brokers(spark: SparkSession, drop_folder: str, root: str) -> str:
    drop, loaded = load_newest_drop(spark, drop_folder, f"{root}/bronze/raw_broker_commissions")
    return f"{drop.rsplit('/', 1)[-1]} rows={loaded}"


def _clean(spark: SparkSession, landing: str, root: str, as_of: datetime, archive: str | None = None) -> str:
    """Clean flights and policies, then the flight statistics from the stored clean flights."""
    create_if_missing(spark, landing, schemas.ddl(schemas.RAW_FLIGHTS))
    raw_flights = landed_flights(spark, landing, archive_path=archive)
    raw_policies = read_bronze(spark, root)["raw_policies"]
    policies_path = f"{root}/bronze/policies_clean"
    bronze.refresh_flights(
        raw_flights, f"{root}/bronze", as_of, landed_since=partial(landed_flights, spark, landing, archive_path=archive)
    )
    write_table(bronze.clean_policies(raw_policies), policies_path)
    report = bronze.removal_report(
        {
            "RAW_FLIGHTS": (raw_flights, bronze.read_clean_flights(raw_flights, f"{root}/bronze")),
            "RAW_POLICIES": (raw_policies, spark.read.parquet(policies_path)),
        }
    )
    return " ".join(
        f"{row['table_name']}:{row['before']}->{row['after']}" for row in report.collect()
    )


def _gold(spark: SparkSession, root: str, as_of: datetime) -> str:
    """Only brokers are read whole; of the other tables, the loads since the last run."""
    path = f"{root}/bronze/raw_broker_commissions"
    bronze_tables = {"raw_broker_commissions": lower_names(read_loads(spark, path))}
    loads = {name: f"{root}/bronze/{name}" for name in latest_store.KEYS}
    star.build_star(bronze_tables, f"{root}/gold", as_of, loads)
    return ""


def _quality(spark: SparkSession, root: str) -> str:
    report = check_store.gold_report(spark, f"{root}/gold")
    path = f"{root}/reports/quality"
    report.write.mode("overwrite").json(path)
    failed = spark.read.schema(report.schema).json(path).filter("status = 'fail'").collect()
    if failed:
        names = ", ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']}" for r in failed)
        raise ValueError(f"failed checks: {names}")
    return "all checks passed"


def _reconcile(spark: SparkSession, sources: Mapping[str, DataFrame], root: str) -> str:
    tables = star.read_gold(spark, f"{root}/gold")
    report = reconcile.reconcile(
        {
            "customers": (sources["customers"], tables["dim_customers"]),
            "policies": (sources["policies"], tables["fact_policies"]),
            "claims": (sources["claims"], tables["fact_claims"]),
        }
    )
    path = f"{root}/reports/reconciliation"
    reconcile.write_report(report, path)
    stored = spark.read.schema(report.schema).json(path)
    if not reconcile.verdict(stored).first()["all_passed"]:
        raise ValueError("one or more tables are below the match threshold")
    return "all tables passed"


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])
