from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.test_ingest import brokers as broker_rows
from wanderlake import schemas
from wanderlake.plans import bronze, daily, gold, silver, star
from wanderlake.sources import broker_files

NOW = datetime(2024, 6, 1, 12)


def customers(spark, n=5):
    rows = [(i, "A", "B", f"A{i}@X.COM ", date(1990, 1, 1), "France", None, NOW - timedelta(days=2)) for i in range(n)]
    return spark.createDataFrame(rows, schemas.ddl(schemas.CUSTOMERS))


def policies(spark, ids, created=NOW, destination=" spain "):
    rows = [(i, i % 5, f"P{i}", destination, date(2024, 1, 1), date(2024, 1, 9), "medical", Decimal("10.00"), "active", 1, created)
            for i in ids]
    return spark.createDataFrame(rows, schemas.ddl(schemas.POLICIES))


def claims(spark, pairs, created=NOW, amount="5.00"):
    rows = [(c, p, "delay", Decimal(amount), date(2024, 2, 1), "approved", None, None, created) for c, p in pairs]
    return spark.createDataFrame(rows, schemas.ddl(schemas.CLAIMS))


def bronze_of(spark, policy_rows, claim_rows):
    return {
        "raw_customers": customers(spark),
        "raw_policies": policy_rows,
        "raw_claims": claim_rows,
        "raw_broker_commissions": broker_rows(spark, "n", date(2024, 1, 1)),
    }


def test_facts_incrementally(spark, folder):
    day1, day2 = NOW - timedelta(days=1), NOW
    first = bronze_of(spark, policies(spark, [1, 2], day1), claims(spark, [(1, 1), (2, 77)], day1))
    star.build_star(first, folder, NOW)
    facts = {r["policy_id"]: r for r in star.read_gold_table(spark, folder, "fact_policies").collect()}
    assert all(facts[1][k] is not None for k in ("customer_sk", "destination_sk", "broker_sk", "date_sk"))
    assert facts[1]["destination_country"] == "SPAIN"

    # Policy 77 arrives after its claim; policy 1 changes; a late row and an equal mark are not seen.
    raw_policies = (
        first["raw_policies"]
        .union(policies(spark, [77], day2))
        .union(policies(spark, [1], day2, "Japan"))
        .union(policies(spark, [50], day1))
        .union(policies(spark, [51], day1 - timedelta(days=3)))
    )
    raw_claims = first["raw_claims"].union(claims(spark, [(3, 77)], day2))
    second = bronze_of(spark, raw_policies, raw_claims)
    for _ in range(2):
        star.build_star(second, folder, NOW)
        facts = {r["policy_id"]: r for r in star.read_gold_table(spark, folder, "fact_policies").collect()}
        assert sorted(facts) == [1, 2, 77]
        assert facts[1]["destination_country"] == "JAPAN"
        by_claim = {r["claim_id"]: r for r in star.read_gold_table(spark, folder, "fact_claims").collect()}
        assert by_claim[1]["destination_country"] == "SPAIN"
        assert by_claim[2]["customer_sk"] is None and by_claim[3]["customer_sk"] is not None

    star.update_policies(raw_policies, folder, lookback=timedelta(days=9))
    assert sorted(r["policy_id"] for r in star.read_gold_table(spark, folder, "fact_policies").collect()) == [1, 2, 50, 51, 77]


def test_a_fact_may_be_empty(spark, folder):
    star.build_star(bronze_of(spark, policies(spark, []), claims(spark, [])), folder, NOW)
    assert star.read_gold_table(spark, folder, "fact_claims").isEmpty()
    star.build_star(bronze_of(spark, policies(spark, [1]), claims(spark, [(1, 1)])), folder, NOW)
    assert star.read_gold_table(spark, folder, "fact_claims").first()["customer_sk"] is not None


def test_trip_after_the_calendar_has_no_date_key(spark):
    rows = policies(spark, [1]).withColumn("trip_start_date", F.lit(date(2026, 1, 1)))
    standard = silver.policies(rows)
    fact = gold.fact_policies(
        standard,
        gold.dim_customers(silver.customers(customers(spark)), NOW),
        gold.dim_destinations(standard),
        gold.dim_brokers(silver.brokers(broker_rows(spark, "n", date(2024, 1, 1)))),
        gold.dim_date(spark),
    ).first()
    assert fact["date_sk"] is None and fact["customer_sk"] is not None


def run(spark, folder, policy_rows, claim_rows):
    broker_files.write_drop(broker_rows(spark, "n", date(2024, 5, 31)), f"{folder}/drops", "2024-05-31")
    sources = {"customers": customers(spark), "policies": policy_rows, "claims": claim_rows}
    status = daily.run_daily(sources, f"{folder}/drops", f"{folder}/landing", f"{folder}/lake", NOW)
    return {r["step"]: r["state"] for r in status.collect()}


def test_daily_run(spark, folder):
    states = run(spark, folder, policies(spark, range(20)), claims(spark, [(i, i) for i in range(20)]))
    assert set(states.values()) == {"success"} and len(states) == 7
    assert star.read_gold_table(spark, f"{folder}/lake/gold", "fact_claims").count() == 20
    assert spark.read.json(f"{folder}/lake/reports/reconciliation").count() == 3
    assert bronze.read_flight_stats(spark, f"{folder}/lake/bronze").count() == 0


def test_failed_checks_do_not_stop_reconciliation(spark, folder):
    rows = claims(spark, [(i, i) for i in range(20)], amount="0.00")
    states = run(spark, folder, policies(spark, range(20)), rows)
    assert states["check_quality"] == "failed" and states["reconcile"] == "success"


def test_idle_sources_skip_the_run(spark, folder):
    old = NOW - timedelta(days=2)
    states = run(spark, folder, policies(spark, [1], old), claims(spark, [(1, 1)], old))
    assert states["check_source_activity"] == "skipped"
    assert {states[s] for s in ("extract_sources", "clean_bronze", "build_gold", "check_quality")} == {"skipped"}
    assert states["reconcile"] == "failed"  # there is nothing to compare with


def test_a_failed_step_blocks_the_next(spark, folder):
    sources = {"customers": customers(spark), "policies": policies(spark, [1]), "claims": claims(spark, [(1, 1)])}
    status = daily.run_daily(sources, f"{folder}/no-drops", f"{folder}/landing", f"{folder}/lake", NOW)
    states = {r["step"]: r["state"] for r in status.collect()}
    assert states["load_broker_file"] == "failed" and states["build_gold"] == "upstream_failed"


def test_join_plans_by_size_give_the_same_facts(spark, folder, monkeypatch):
    """Small tables, few facts and large on both sides: three plans, one result."""
    day1, day2 = NOW - timedelta(days=1), NOW
    first = bronze_of(spark, policies(spark, range(30), day1), claims(spark, [(i, i % 7) for i in range(30)], day1))
    second = bronze_of(
        spark,
        first["raw_policies"].union(policies(spark, range(20, 50), day2, "uk")),
        first["raw_claims"].union(claims(spark, [(i, i) for i in range(25, 60)], day2)),
    )

    def result(name, rule):
        monkeypatch.setattr(star, "small_enough", rule)
        for run_input in (first, second):
            star.build_star(run_input, f"{folder}/{name}", NOW)
        return [
            sorted(map(repr, star.read_gold_table(spark, f"{folder}/{name}", t).collect()))
            for t in ("fact_policies", "fact_claims")
        ]

    def only_batches(table):
        is_fact = "customer_sk" in table.columns
        return not is_fact and ("claim_type" in table.columns or "coverage_type" in table.columns)

    small = result("small", lambda table: True)
    assert result("few", only_batches) == small
    assert result("large", lambda table: False) == small


def test_a_run_cut_short_is_repeated(spark, folder, monkeypatch):
    day1, day2 = NOW - timedelta(days=1), NOW
    first = bronze_of(spark, policies(spark, [1], day1), claims(spark, [(1, 1)], day1))
    star.build_star(first, folder, NOW)
    grown = first["raw_policies"].union(policies(spark, [2, 3], day2))
    with monkeypatch.context() as patch:
        patch.setattr(star, "save_state", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            star.update_policies(grown, folder)
    late = grown.union(policies(spark, [4], day2))
    star.update_policies(late, folder)
    assert sorted(r["policy_id"] for r in star.read_gold_table(spark, folder, "fact_policies").collect()) == [1, 2, 3, 4]
