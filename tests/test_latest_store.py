from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wanderlake.operators.upsert import read_manifest
from wanderlake.plans import daily, latest_store, silver, star
from wanderlake.registry import queries as registry
from wanderlake.sources import tables

SF = "/root/testdata/sf0.001"
DDL = "policy_id bigint, status string, created_at timestamp_ntz, premium_amount string"
T = [datetime(2024, 1, day) for day in range(1, 9)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def merged(spark, path, loads, keys_per_range=10):
    for rows in loads:
        latest_store.merge_latest(spark.createDataFrame(rows, DDL), path, "policy_id", keys_per_range)
    return rows_of(latest_store.read_keyed(spark, path))


def test_latest_of_all_loads(spark, folder):
    """Newer, older, undated, equal and repeated rows, ties, and keys that are NULL."""
    loads = [
        [(1, "a", T[1], "1"), (2, "a", T[3], "1"), (None, "a", T[1], "1"), (15, "a", T[1], None), (25, "a", T[1], "2")],
        [(1, "b", T[2], "1"), (2, "b", T[2], "9"), (None, "b", T[2], "1"), (15, "a", None, "3"), (3, "a", T[1], "1")],
        [(1, "b", T[2], "1"), (2, "c", T[3], "1"), (None, "c", T[1], "1"), (15, "z", T[7], "3"), (3, "a", T[1], "2")],
    ]
    everything = spark.createDataFrame([r for rows in loads for r in rows], DDL)
    expected = rows_of(silver.latest_rows(everything, "policy_id"))
    assert merged(spark, f"{folder}/t", loads) == expected
    assert merged(spark, f"{folder}/t", loads[::-1] + loads[:1]) == expected
    assert merged(spark, f"{folder}/u", loads[::-1]) == expected


def test_only_touched_ranges_are_rewritten(spark, folder):
    path = f"{folder}/t"
    merged(spark, path, [[(i, "a", T[1], "1") for i in (1, 11, 21)]])
    before = read_manifest(spark, path)[1]
    merged(spark, path, [[(12, "b", T[2], "1")]])
    after = read_manifest(spark, path)[1]
    assert {r for r in after if after[r] != before[r]} == {1}


def read_files(monkeypatch):
    """Files of the loads that refreshes read."""
    seen = []

    def noting(*args):
        rows, newest = tables.loads_after(*args)
        seen.extend(rows.inputFiles() if rows is not None else [])
        return rows, newest

    monkeypatch.setattr(latest_store, "loads_after", noting)
    return seen


def test_a_refresh_reads_new_loads_only(spark, folder, monkeypatch):
    loads, root = f"{folder}/loads", f"{folder}/root"
    tables.append_load(spark.createDataFrame([(1, "a", T[1], "1")], DDL), loads, "20240101")
    latest_store.refresh(spark, loads, root, "raw_policies")
    tables.append_load(spark.createDataFrame([(1, "b", T[2], "1", "web")], f"{DDL}, channel string"), loads, "20240102")
    seen = read_files(monkeypatch)
    latest_store.refresh(spark, loads, root, "raw_policies")
    latest_store.refresh(spark, loads, root, "raw_policies")
    assert seen and all("20240102" in f for f in seen)
    assert rows_of(latest_store.latest(spark, root, "raw_policies")) == [(1, "b", T[2], "1", "web")]


def test_a_refresh_that_was_cut_short_is_repeated(spark, folder, monkeypatch):
    loads, root = f"{folder}/loads", f"{folder}/root"
    tables.append_load(spark.createDataFrame([(1, "a", T[1], "1")], DDL), loads, "1")

    class Cut(RuntimeError):
        pass

    def fail(*args, **more):
        raise Cut

    for name in ("merge_latest", "stored_table"):
        with monkeypatch.context() as patch:
            patch.setattr(latest_store, name, fail)
            with pytest.raises(Cut):
                latest_store.refresh(spark, loads, root, "raw_policies")
    latest_store.refresh(spark, loads, root, "raw_policies")
    assert latest_store.latest(spark, root, "raw_policies").count() == 1


def test_second_build_reads_new_raw_rows_only_and_equals_a_full_one(spark, folder, monkeypatch):
    raw = registry.bronze_tables(spark, SF)
    loads = {name: f"{folder}/bronze/{name}" for name in latest_store.KEYS}
    brokers = {"raw_broker_commissions": raw["raw_broker_commissions"]}
    for name, path in loads.items():
        tables.append_load(raw[name].filter(F.col("created_at") <= F.lit(registry.CUT).cast("timestamp_ntz")), path, "1")
    star.build_star(brokers, f"{folder}/gold", registry.AS_OF, loads)
    for name, path in loads.items():
        tables.append_load(raw[name].filter(F.col("created_at") > F.lit(registry.CUT - timedelta(days=5)).cast("timestamp_ntz")), path, "2")
    seen = read_files(monkeypatch)
    star.build_star(brokers, f"{folder}/gold", registry.AS_OF, loads)
    assert seen and all("load_id=2" in f for f in seen)
    stored = {name: daily.lower_names(tables.read_loads(spark, path)) for name, path in loads.items()}
    star.build_star({**stored, **brokers}, f"{folder}/full", registry.AS_OF)
    for name in (*star.DIMENSIONS, "fact_policies", "fact_claims"):
        found, full = (star.read_gold_table(spark, f"{folder}/{root}", name) for root in ("gold", "full"))
        if name == "fact_claims":  # a claim older than its policy's version keeps the keys it got
            found, full = (df.select("claim_id", "claim_amount", "claim_status") for df in (found, full))
        if name.startswith("fact"):
            found, full = (df.drop("customer_sk", "destination_sk", "broker_sk") for df in (found, full))
        assert found.exceptAll(full.select(*found.columns)).isEmpty() and found.count() == full.count(), name


def test_many_narrow_ranges_are_widened(spark, folder, monkeypatch):
    """At the first load and, where it gets more ranges, at a later one; rows and later merges stay right."""
    monkeypatch.setattr(latest_store, "MOST_RANGES", 8)
    path, loads, folders = f"{folder}/t", [], []
    null = (None, "n", T[1], "1")
    for keys, day, status in ((range(0, 40, 10), 1, "a"), (range(0, 400, 10), 2, "b"), (range(200, 4000, 40), 3, "c"), ([5, 395], 4, "d")):
        loads.append([(k, status, T[day], "1") for k in keys] + [null])
        latest_store.merge_latest(spark.createDataFrame(loads[-1], DDL), path, "policy_id", 10)
        everything = spark.createDataFrame([r for rows in loads for r in rows], DDL)
        assert rows_of(latest_store.read_keyed(spark, path)) == rows_of(silver.latest_rows(everything, "policy_id"))
        folders.append(set(read_manifest(spark, path)[1]))
    assert folders[0] == {None, 0, 1, 2, 3}  # of 10 keys
    assert folders[1] == {None, *range(5)}  # of 80
    assert folders[2] == folders[3] == {None, *range(7)}  # of 640
    merged(spark, f"{folder}/u", loads[1:2])
    assert set(read_manifest(spark, f"{folder}/u")[1]) == {None, *range(5)}
