from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from tools.compare import digest
from wanderlake.registry.oracle import ORACLE
from wanderlake.registry.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")


def test_every_query_and_its_sql_are_handed_over():
    assert QUERIES.items() <= registry.queries().items()
    assert ORACLE.items() <= registry.oracle_sql().items()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, db, name):
    df = QUERIES[name](spark, str(FOLDER))
    rows = [tuple(r) for r in df.collect()]
    result = db.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    ours, ours_lines = digest(df.columns, rows)
    theirs, their_lines = digest(names, result.fetchall())
    assert ours_lines[:5] == their_lines[:5]
    assert ours == theirs


def test_daily_run_reports_every_step(spark):
    states = {r["step"]: r["state"] for r in QUERIES["daily_run"](spark, str(FOLDER)).collect()}
    # The inputs break the positive-amount rule and hold repeated claims on purpose.
    assert states.pop("check_quality") == "failed" and states.pop("reconcile") == "failed"
    assert set(states.values()) == {"success"}


def test_entry(spark):
    assert registry.entry(spark).columns == ["destination_country", "total_premium"]
