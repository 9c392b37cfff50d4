from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from wanderlake import schemas
from wanderlake.operators.upsert import upsert
from wanderlake.plans import result_store, star

NOW = datetime(2024, 6, 1, 12)
TEXT = "SELECT policy_status, count(*) AS n FROM {fact_policies} GROUP BY policy_status ORDER BY n DESC, policy_status"


def load(spark, folder, rows):
    columns = schemas.ddl(star.FACTS["fact_policies"])
    empty = spark.createDataFrame([], columns)
    batch = spark.createDataFrame(rows, "policy_id bigint, policy_status string")
    upsert(empty.unionByName(batch, allowMissingColumns=True), f"{folder}/fact_policies", "policy_id")


def ask(spark, folder, text=TEXT, as_of=NOW, names=("fact_policies",)):
    rows = result_store.query(spark, text, folder, names, f"{folder}/results", as_of)
    return [tuple(r) for r in rows.collect()], rows.inputFiles()


def test_a_second_call_reads_the_result_until_a_load(spark, folder):
    load(spark, folder, [(1, "active"), (2, "active"), (3, "expired")])
    first, _ = ask(spark, folder)
    assert first == [("active", 2), ("expired", 1)]
    again, files = ask(spark, folder, TEXT.replace(" FROM", "\n   FROM") + " ;")
    assert again == first and files and all("/results/" in f for f in files)
    assert len(list(Path(folder, "results").glob("*/*"))) == 1
    load(spark, folder, [(1, "expired"), (4, "expired")])
    assert ask(spark, folder)[0] == [("expired", 3), ("active", 1)]
    assert len(list(Path(folder, "results").glob("*/*"))) == 2


def test_results_have_a_life_time(spark, folder):
    load(spark, folder, [(1, "active")])
    for minutes, stored in ((0, 1), (4, 1), (5, 2), (11, 2)):
        ask(spark, folder, as_of=NOW + timedelta(minutes=minutes))
        assert len(list(Path(folder, "results").glob("*/*"))) == stored, minutes
    result_store.forget(spark, f"{folder}/results", NOW + timedelta(days=1))
    assert not list(Path(folder, "results").iterdir())


def test_half_a_result_is_not_read(spark, folder):
    load(spark, folder, [(1, "active")])
    expected, _ = ask(spark, folder)
    (whole,) = Path(folder, "results").glob("*/*")
    half = whole.with_name(f"{int(whole.name.split('-')[0]) + 1:012d}-half")
    half.mkdir()
    assert ask(spark, folder, as_of=NOW + timedelta(minutes=1))[0] == expected


def test_a_rewritten_dimension_is_another_state(spark, folder):
    dimension = spark.createDataFrame([(1, "x")], "destination_sk bigint, destination_country string")
    text = "SELECT count(*) AS n FROM {dim_destinations}"
    for rows in (dimension, dimension.union(dimension)):
        rows.write.mode("overwrite").parquet(f"{folder}/dim_destinations")
        assert ask(spark, folder, text, names=["dim_destinations"])[0] == [(rows.count(),)]


def test_equal_names_and_faulty_queries_store_nothing(spark, folder):
    load(spark, folder, [(1, "active")])
    assert ask(spark, folder, "SELECT 1 AS a, 2 AS A FROM {fact_policies}")[0] == [(1, 2)]
    with pytest.raises(Exception, match="no_such"):
        ask(spark, folder, "SELECT no_such FROM {fact_policies}")
    assert not Path(folder, "results").exists()


def test_texts_that_mean_the_same():
    same = result_store.normalised
    assert same("SELECT  1\n FROM t;") == same("SELECT 1 FROM t")
    assert same("SELECT 'a  b'") != same("SELECT 'a b'")
    assert same("SELECT 1 -- x\n, 2") != same("SELECT 1 -- x , 2")
    assert same("SELECT '--',  1") == same("SELECT '--', 1")
