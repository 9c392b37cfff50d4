from __future__ import annotations

import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake import schemas
from wanderlake.sources import broker_files, extract, tables

T0 = datetime(2024, 1, 1)


def source(spark, days):
    rows = [(i, T0 + timedelta(days=d) if d is not None else None) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "id bigint, created_at timestamp_ntz")


def brokers(spark, name, day):
    row = (1, name, " c", "UK", 3, "10.00", 0.1, "1.00", day)
    df = spark.createDataFrame([row], "a bigint, b string, c string, d string, e bigint, f string, g double, h string, i date")
    return df.toDF(*schemas.RAW_BROKER_COMMISSIONS)


def test_extract_is_strictly_after_the_mark(spark):
    df = source(spark, [0, 1, 2, None])
    assert extract.extract(df, None).count() == 4
    assert [r["id"] for r in extract.extract(df, T0 + timedelta(days=1)).collect()] == [2]


def test_extract_filter_reaches_the_scan(spark, folder):
    source(spark, [0]).write.parquet(f"{folder}/s")
    assert "GreaterThan(created_at" in plan_of(extract.extract(spark.read.parquet(f"{folder}/s"), T0))


def test_runs_use_the_start_of_the_last_run(spark, folder):
    names = ("customers", "policies", "claims")
    first = {n: source(spark, [0, 1]) for n in names}
    run1, run2 = T0 + timedelta(days=1, hours=1), T0 + timedelta(days=9)
    got = extract.run_extract(first, f"{folder}/b", f"{folder}/s", run1).collect()
    assert [tuple(r) for r in got] == [(n, 2, 2) for n in names]
    grown = {n: source(spark, [0, 1, 2] if n != "claims" else [0, 1]) for n in names}
    got = extract.run_extract(grown, f"{folder}/b", f"{folder}/s", run2).collect()
    assert [tuple(r) for r in got] == [("customers", 1, 1), ("policies", 1, 1), ("claims", 0, 0)]
    assert extract.load_state(spark, f"{folder}/s") == {n: run2 for n in names}
    stored = tables.read_loads(spark, f"{folder}/b/raw_customers")
    assert stored.columns == ["ID", "CREATED_AT"] and stored.count() == 3


def test_a_failed_run_leaves_the_marks(spark, folder):
    good = source(spark, [0])
    bad = good.withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        extract.run_extract({"customers": good, "policies": bad, "claims": good}, f"{folder}/b", f"{folder}/s", T0)
    assert extract.load_state(spark, f"{folder}/s") == {}


def test_append_load(spark, folder):
    path = f"{folder}/t"
    assert tables.append_load(source(spark, []), path, "0") == 0
    assert not os.path.exists(path)
    assert tables.append_load(source(spark, [1, 2]), path, "a") == 2
    assert tables.append_load(source(spark, [1, 2]), path, "a") == 2
    assert tables.append_load(source(spark, [3]), path, "b") == 1
    assert tables.read_loads(spark, path).count() == 3


def test_create_if_missing(spark, folder):
    tables.create_if_missing(spark, f"{folder}/t", schemas.ddl(schemas.RAW_FLIGHTS))
    df = spark.read.parquet(f"{folder}/t")
    assert df.columns == list(schemas.RAW_FLIGHTS) and df.isEmpty()
    tables.write_table(spark.range(1), f"{folder}/u")
    tables.create_if_missing(spark, f"{folder}/u", "x int")
    assert tables.read_table(spark, f"{folder}/u").columns == ["id"]


def test_row_counts_and_sql(spark):
    counts = tables.row_counts({"b": spark.range(2), "a": spark.range(0)})
    assert [tuple(r) for r in counts.collect()] == [("a", 0), ("b", 2)]
    assert tables.run_query(spark, "SELECT count(*) AS n FROM {t}", {"t": spark.range(3)}).first()["n"] == 3
    with pytest.raises(Exception):
        tables.run_query(spark, "SELECT nothing FROM nowhere", {})


def test_newest_drop_wins(spark, folder):
    with pytest.raises(FileNotFoundError):
        broker_files.newest_drop(spark, folder)
    late = broker_files.write_drop(brokers(spark, " late", date(2024, 1, 1)), folder, "2024-01-01")
    early = broker_files.write_drop(brokers(spark, "early", date(2024, 1, 2)), folder, "2024-01-02")
    old = time.time() - 1_000
    for name in os.listdir(early):
        os.utime(f"{early}/{name}", (old, old))
    assert broker_files.newest_drop(spark, folder).removeprefix("file:") == late
    drop, loaded = broker_files.load_newest_drop(spark, folder, f"{folder}/bronze")
    assert loaded == 1
    stored = tables.read_loads(spark, f"{folder}/bronze")
    assert stored.columns == [c.upper() for c in schemas.RAW_BROKER_COMMISSIONS]
    assert stored.first()["BROKER_NAME"] == " late"


def test_a_drop_may_be_one_plain_file(spark, folder):
    header = ",".join(schemas.RAW_BROKER_COMMISSIONS)
    with open(f"{folder}/broker_commissions_2024_02_01.csv", "w") as out:
        out.write(f"{header}\n7,n,c,UK,3,10.00,0.1,1.00,2024-02-01\n")
    drop = broker_files.newest_drop(spark, folder)
    assert broker_files.read_drop(spark, drop).first()["broker_id"] == 7


def test_drop_columns_are_found_by_name(spark, folder):
    rows = brokers(spark, "n", date(2024, 1, 1))
    plain = broker_files.read_drop(spark, broker_files.write_drop(rows, f"{folder}/a", "2024-01-01"))
    turned = list(schemas.RAW_BROKER_COMMISSIONS)[::-1]
    path = broker_files.write_drop(rows, f"{folder}/b", "2024-01-01", turned)
    assert broker_files.read_drop(spark, path).collect() == plain.collect()
    assert plain.dtypes == list(schemas.RAW_BROKER_COMMISSIONS.items())
    path = broker_files.write_drop(rows, f"{folder}/c", "2024-01-01", turned[1:])
    with pytest.raises(ValueError, match=turned[0]):
        broker_files.read_drop(spark, path)


def test_columns_of_later_loads_are_read(spark, folder):
    tables.append_load(source(spark, [1]), f"{folder}/t", "a")
    tables.append_load(source(spark, [2]).withColumn("newcol", F.lit("x")), f"{folder}/t", "b")
    rows = {r["NEWCOL"] for r in tables.read_loads(spark, f"{folder}/t").collect()}
    assert rows == {None, "x"}
