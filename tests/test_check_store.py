from __future__ import annotations

from pathlib import Path

import pytest

from wanderlake.operators import upsert as module
from wanderlake.operators.upsert import upsert
from wanderlake.plans import check_store, quality
from wanderlake.registry import queries as registry

SF = "/root/testdata/sf0.001"
PARENT = "id bigint, name string"
CHILD = "cid bigint, parent bigint, amount int"


def parents(spark, folder, ids, **options):
    upsert(spark.createDataFrame([(i, "p") for i in ids], PARENT), f"{folder}/parents", "id", keys_per_range=10, **options)


def childs(spark, folder, rows, **options):
    upsert(spark.createDataFrame(rows, CHILD), f"{folder}/t", "cid", keys_per_range=10, **options)


def checks(parents):
    return [
        quality.NotNull("cid"), quality.Unique("cid"), quality.ExpressionIsTrue("amount", "> 0"),
        quality.Relationship("parent", parents, "id"),
    ]


def report(spark, folder):
    known = module.read_keyed(spark, f"{folder}/parents")
    known = spark.createDataFrame([], PARENT) if known is None else known
    rows = check_store.fact_report(spark, folder, "t", "cid", checks(known), f"{folder}/parents", 10)
    stored = module.read_keyed(spark, f"{folder}/t")
    stored = spark.createDataFrame([], CHILD) if stored is None else stored
    full = quality.run_checks("t", stored, checks(known))
    assert rows.columns == full.columns
    found = sorted(tuple(r) for r in rows.collect())
    assert found == sorted(tuple(r) for r in full.collect())
    return {name: failures for _, name, _, failures, _ in found}


@pytest.fixture
def scanned(monkeypatch):
    """Files that the scans for checks were planned over, by key range."""
    seen = []
    scan = check_store._scan

    def watched(rows, key, wanted):
        seen.append({Path(f).parent.name.split("=")[1] for f in rows.inputFiles() if "key_range=" in f})
        return scan(rows, key, wanted)

    monkeypatch.setattr(check_store, "_scan", watched)
    return seen


def test_only_changed_ranges_are_scanned(spark, folder, scanned):
    parents(spark, folder, [1, 15])
    childs(spark, folder, [(1, 1, 5), (12, 15, 0), (25, 99, 7), (26, None, None), (None, 1, -1)])
    assert report(spark, folder) == {"not_null": 1, "unique": 0, "expression_is_true": 2, "relationships": 1}
    assert scanned == [{"0", "1", "2", "__HIVE_DEFAULT_PARTITION__"}]
    assert report(spark, folder)["relationships"] == 1
    assert len(scanned) == 1
    childs(spark, folder, [(12, 15, 3), (13, 77, 3)])
    assert report(spark, folder) == {"not_null": 1, "unique": 0, "expression_is_true": 1, "relationships": 2}
    assert scanned[1:] == [{"1"}]


def test_an_orphan_finds_its_parent_without_a_scan(spark, folder, scanned):
    childs(spark, folder, [(1, 99, 5), (2, 99, 5), (3, 55, 5)])
    assert report(spark, folder)["relationships"] == 3
    parents(spark, folder, [99])
    assert report(spark, folder)["relationships"] == 1
    parents(spark, folder, [55])
    assert report(spark, folder)["relationships"] == 0
    assert len(scanned) == 1


def test_deltas_and_compactions_are_changes(spark, folder, scanned):
    parents(spark, folder, [1])
    childs(spark, folder, [(1, 1, 0), (2, 1, 0), (11, 1, 0)])
    assert report(spark, folder)["expression_is_true"] == 3
    childs(spark, folder, [(1, 1, 9)], deltas=True)
    assert report(spark, folder)["expression_is_true"] == 2
    module.compact(spark, f"{folder}/t")
    assert report(spark, folder)["expression_is_true"] == 2
    assert scanned[1:] == [{"0"}, {"0"}]


def test_repeated_keys_are_found_within_their_range(spark, folder):
    childs(spark, folder, [(1, None, 1), (1, None, 1), (11, None, 1), (11, None, 1), (11, None, 1), (12, None, 1)], known_unique=True)
    assert report(spark, folder)["unique"] == 2


def test_empty_tables_pass(spark, folder):
    assert set(report(spark, folder).values()) == {0}


def test_a_report_cut_short_is_repeated(spark, folder):
    childs(spark, folder, [(1, 9, 0)])

    path = f"{folder}/checks/t/run-000000009-half"
    spark.createDataFrame([("x", "not_null", "cid", 7)], check_store.FOUND).write.parquet(f"{path}/found")
    assert report(spark, folder) == {"not_null": 0, "unique": 0, "expression_is_true": 1, "relationships": 1}


def test_old_runs_are_removed(spark, folder):
    for i in range(4):
        childs(spark, folder, [(i, None, i)])
        report(spark, folder)
    assert len(list(Path(folder, "checks", "t").glob("run-*"))) == 2


def test_uniqueness_of_another_column_is_refused(spark, folder):
    with pytest.raises(ValueError, match="parent"):
        check_store.fact_report(spark, folder, "t", "cid", [quality.Unique("parent")], f"{folder}/parents")


def test_the_star_report_equals_the_full_one(spark):
    found = check_store.gold_report(spark, registry.star_root(spark, SF))
    full = registry.quality_report(spark, SF)
    assert found.columns == full.columns
    assert found.exceptAll(full).isEmpty() and found.count() == full.count()
