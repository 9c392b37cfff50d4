from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wanderlake import schemas
from wanderlake.operators import upsert as module
from wanderlake.operators.upsert import upsert
from wanderlake.plans import metrics, report_store, star
from wanderlake.registry import queries as registry

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2025, 6, 30)
DESTINATIONS = [("x", "FRANCE", "Europe"), ("y", "JAPAN", "Asia"), (None, None, "Unknown")]


def policies(spark, rows):
    """Rows of (policy_id, day, destination_sk, premium)."""
    columns = list(schemas.FACT_POLICIES)
    full = []
    for key, day, place, premium in rows:
        known = {"policy_id": key, "trip_start_date": day, "destination_sk": place, "premium_amount": premium and Decimal(premium)}
        full.append(tuple(known.get(c) for c in columns))
    return spark.createDataFrame(full, schemas.ddl(schemas.FACT_POLICIES))


def claims(spark, rows):
    """Rows of (claim_id, type, status, destination_sk, amount)."""
    columns = list(schemas.FACT_CLAIMS)
    full = []
    for key, kind, status, place, amount in rows:
        known = {
            "claim_id": key, "claim_type": kind, "claim_status": status, "destination_sk": place,
            "claim_amount": amount and Decimal(amount), "is_approved": None if status is None else status == "approved",
        }
        full.append(tuple(known.get(c) for c in columns))
    return spark.createDataFrame(full, schemas.ddl(schemas.FACT_CLAIMS))


@pytest.fixture
def root(spark, folder):
    spark.createDataFrame(DESTINATIONS, "destination_sk string, destination_country string, continent string").write.parquet(
        f"{folder}/dim_destinations"
    )
    return folder


@pytest.fixture
def scanned(monkeypatch):
    """Key ranges whose files were read to be summed."""
    seen = []
    read = report_store.rows_by_state

    def watched(spark, path, entries):
        rows = read(spark, path, entries)
        seen.append({Path(f).parent.name.split("=")[1] for f in rows.inputFiles() if "key_range=" in f})
        return rows

    monkeypatch.setattr(report_store, "rows_by_state", watched)
    return seen


def load(spark, root, name, key, rows, **options):
    upsert(rows, f"{root}/{name}", key, keys_per_range=10, **options)


def same(maintained, full):
    assert maintained.schema.simpleString() == full.schema.simpleString()
    found = maintained.collect()
    assert found == full.collect()
    return found


def policy_reports(spark, root):
    fact = star.read_gold_table(spark, root, "fact_policies")
    places = star.read_gold_table(spark, root, "dim_destinations")
    by_month = same(report_store.revenue_by_month(spark, root), metrics.revenue_by_month(fact))
    by_place = same(report_store.premium_by_destination(spark, root), metrics.premium_by_destination(fact, places))
    same(report_store.revenue_kpis(spark, root, AS_OF), metrics.revenue_kpis(metrics.revenue_by_month(fact), AS_OF))
    return {r["month"]: (r["total_premium"], r["policy_count"]) for r in by_month}, {r[0]: r[1] for r in by_place}


def claim_reports(spark, root):
    fact = star.read_gold_table(spark, root, "fact_claims")
    places = star.read_gold_table(spark, root, "dim_destinations")
    same(report_store.claims_by_type(spark, root), metrics.claims_by_type(fact))
    same(report_store.approval_by_type(spark, root), metrics.approval_by_type(fact))
    same(report_store.average_claim_by_destination(spark, root), metrics.average_claim_by_destination(fact, places))
    return same(report_store.claim_kpis(spark, root), metrics.claim_kpis(fact))[0]


MAY, JUNE = date(2025, 5, 7), date(2025, 6, 7)


def test_rows_move_between_groups_and_only_their_range_is_summed(spark, root, scanned):
    load(spark, root, "fact_policies", "policy_id", policies(spark, [
        (1, MAY, "x", "10.00"), (2, MAY, "y", "5.50"), (11, JUNE, "x", None), (12, None, None, "1.25"), (None, JUNE, "y", "2.00"),
    ]))
    by_month, by_place = policy_reports(spark, root)
    assert by_month == {None: (Decimal("1.25"), 1), date(2025, 5, 1): (Decimal("15.50"), 2), date(2025, 6, 1): (Decimal("2.00"), 2)}
    assert scanned == [{"0", "1", "__HIVE_DEFAULT_PARTITION__"}]
    load(spark, root, "fact_policies", "policy_id", policies(spark, [(2, JUNE, "x", "5.50")]))
    by_month, by_place = policy_reports(spark, root)
    assert by_month[date(2025, 5, 1)] == (Decimal("10.00"), 1) and by_month[date(2025, 6, 1)] == (Decimal("7.50"), 3)
    assert by_place["FRANCE"] == Decimal("15.50") and by_place["JAPAN"] == Decimal("2.00")
    assert scanned[1:] == [{"0"}]


def test_deltas_and_compactions_are_summed_again(spark, root, scanned):
    load(spark, root, "fact_claims", "claim_id", claims(spark, [
        (1, "medical", "approved", "x", "10.00"), (2, "medical", "rejected", "x", "20.00"), (11, None, None, None, None),
    ]))
    assert claim_reports(spark, root)["approved_claims"] == 1
    load(spark, root, "fact_claims", "claim_id", claims(spark, [(2, "delay", "approved", "y", "21.00"), (3, "delay", "pending", "y", None)]), deltas=True)
    kpis = claim_reports(spark, root)
    assert (kpis["total_claims"], kpis["approved_claims"], kpis["approval_rate"]) == (4, 2, 50.0)
    module.compact(spark, f"{root}/fact_claims")
    assert claim_reports(spark, root)["total_claims"] == 4
    assert scanned == [{"0", "1"}, {"0"}, {"0"}]


def test_a_new_column_sums_every_range_again(spark, root, scanned):
    load(spark, root, "fact_policies", "policy_id", policies(spark, [(1, MAY, "x", "1.00"), (11, MAY, "x", "1.00")]))
    policy_reports(spark, root)
    load(spark, root, "fact_policies", "policy_id", policies(spark, [(1, MAY, "x", "3.00")]).withColumn("channel", F.lit("web")))
    by_month, _ = policy_reports(spark, root)
    assert by_month[date(2025, 5, 1)] == (Decimal("4.00"), 2)
    assert scanned == [{"0", "1"}, {"0", "1"}]


def test_empty_facts(spark, root):
    assert policy_reports(spark, root) == ({}, {})
    kpis = claim_reports(spark, root)
    assert (kpis["total_claims"], kpis["approved_claims"], kpis["approval_rate"]) == (0, None, None)


def test_a_report_cut_short_is_repeated_and_old_runs_go(spark, root):
    for i in range(4):
        load(spark, root, "fact_policies", "policy_id", policies(spark, [(i, MAY, "x", "1.00")]))
        assert policy_reports(spark, root)[0][date(2025, 5, 1)][1] == i + 1
    store = next(Path(root, "cells").iterdir())
    runs = sorted(store.glob("run-*"))
    assert len(runs) == 2
    (runs[-1] / "_SUCCESS").unlink()
    assert policy_reports(spark, root)[0][date(2025, 5, 1)][1] == 4


def test_another_definition_has_its_own_cells(spark, root, monkeypatch):
    load(spark, root, "fact_policies", "policy_id", policies(spark, [(1, MAY, "x", "1.00")]))
    policy_reports(spark, root)
    monkeypatch.setitem(report_store.CELLS, "fact_policies", lambda: report_store.Cells(
        report_store.policy_cells().groups, {**report_store.policy_cells().sums, "twice": F.sum(F.lit(2))}
    ))
    assert report_store.current_cells(spark, root, "fact_policies").first()["twice"] == 2


def test_reports_of_the_star_equal_the_full_ones(spark):
    root = registry.star_root(spark, SF)
    policy_reports(spark, root)
    claim_reports(spark, root)
