from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake.plans import bronze, silver

FLIGHTS = (
    "icao24 string, callsign string, origin_country string, longitude double, latitude double, "
    "altitude double, velocity double, heading double, on_ground string, "
    "event_timestamp timestamp_ntz, ingested_at timestamp_ntz"
)
POLICIES = (
    "policy_id bigint, customer_id bigint, policy_number string, destination_country string, "
    "trip_start_date date, trip_end_date date, coverage_type string, premium_amount string, "
    "status string, broker_id bigint, created_at timestamp_ntz"
)
CLAIMS = (
    "claim_id bigint, policy_id bigint, claim_type string, claim_amount string, claim_date date, "
    "status string, description string, processed_at timestamp_ntz, created_at timestamp_ntz"
)
NOW = datetime(2025, 1, 1)


def flight(icao, second, lat=1.0, lon=2.0, ground="true", call="AB1"):
    return (icao, call, "X", lon, lat, 1.0, 2.0, 3.0, ground, datetime(2024, 1, 1, 0, 0, second), NOW)


def policy(pid, created, status="active", premium="10.00", number=None):
    return (pid, 1, number or f" P{pid} ", " spain ", date(2024, 1, 1), date(2024, 1, 11), " medical",
            premium, status, 1, created)


def test_position_is_tested_after_the_latest_event_is_chosen(spark):
    raw = spark.createDataFrame(
        [flight("a", 1), flight("a", 20, lat=None), flight("a", 31), flight("b", 5, ground="Yes"), flight("b", 6, ground=None)],
        FLIGHTS,
    )
    clean = bronze.clean_flights(raw, NOW).orderBy("icao24", "event_timestamp").collect()
    assert [(r["icao24"], r["event_timestamp"].second, r["on_ground"]) for r in clean] == [
        ("a", 31, True), ("b", 6, False),
    ]
    assert clean[0]["ingested_at"] == NOW


def test_flights_without_event_time_are_one_group(spark):
    row = list(flight("a", 1))
    row[9] = None
    raw = spark.createDataFrame([tuple(row), tuple(row[:1] + ["Z"] + row[2:]), flight("a", 1)], FLIGHTS)
    assert bronze.clean_flights(raw, NOW).count() == 2


def test_clean_policies(spark):
    raw = spark.createDataFrame(
        [policy(1, datetime(2024, 1, 1), premium="1.005"), policy(2, datetime(2024, 1, 2), premium="bad", number=" P1 ")],
        POLICIES,
    )
    rows = bronze.clean_policies(raw).collect()
    assert len(rows) == 1
    assert (rows[0]["policy_id"], rows[0]["policy_number"], rows[0]["premium_amount"]) == (2, "P1", None)


def test_daily_stats(spark):
    raw = spark.createDataFrame([flight("a", 1), flight("b", 2, ground="no")], FLIGHTS)
    row = bronze.flight_daily_stats(bronze.clean_flights(raw, NOW)).first()
    assert (row["flight_day"], row["flight_count"], row["pct_on_ground"]) == (date(2024, 1, 1), 2, 50.0)


def test_removal_report(spark):
    raw = spark.createDataFrame([flight("a", 1), flight("a", 2)], FLIGHTS)
    report = bronze.removal_report({"F": (raw, bronze.clean_flights(raw, NOW))})
    assert tuple(report.first()) == ("F", 2, 1, 1)


def test_cancelled_without_premium(spark):
    pairs = [(s, p) for s in ("Cancelled ", "active", None) for p in ("5", "n/a", None)]
    raw = spark.createDataFrame(
        [policy(i, datetime(2024, 1, 1), s, p) for i, (s, p) in enumerate(pairs)], POLICIES
    )
    kept = {r["policy_id"]: r["premium_amount"] for r in silver.policies(raw).collect()}
    assert kept == {
        0: Decimal("5.00"), 1: None, 3: Decimal("5.00"), 4: None, 5: None, 6: Decimal("5.00"), 7: None,
    }


def test_policy_columns(spark):
    raw = spark.createDataFrame([policy(1, datetime(2024, 1, 1))], POLICIES)
    row = silver.policies(raw).first()
    assert row["policy_number"] == "P1" and row["destination_country"] == "spain"
    assert row["coverage_type"] == "MEDICAL" and row["trip_duration_days"] == 10


def test_incremental_read_equals_late_filter(spark):
    """Dropping old rows before the deduplication never changes what is newer than the mark."""
    rng = random.Random(5)
    times = [None, *[datetime(2024, 1, d) for d in range(1, 9)]]
    rows = [policy(rng.randrange(40), rng.choice(times), premium=str(rng.randrange(100))) for _ in range(400)]
    raw = spark.createDataFrame(rows, POLICIES)
    for mark in (datetime(2023, 1, 1), datetime(2024, 1, 3), datetime(2024, 1, 8)):
        late = silver.policies(raw).filter(f"created_at > timestamp_ntz'{mark}'")
        early = silver.policies(raw, mark)
        assert sorted(map(repr, early.collect())) == sorted(map(repr, late.collect()))


def test_incremental_read_reaches_the_scan(spark, folder):
    spark.createDataFrame([policy(1, datetime(2024, 1, 1))], POLICIES).write.parquet(f"{folder}/p")
    plan = plan_of(silver.policies(spark.read.parquet(f"{folder}/p"), datetime(2024, 1, 1)))
    assert "PushedFilters: [Or(GreaterThan(created_at" in plan


def test_claims(spark):
    day = date(2024, 1, 1)
    raw = spark.createDataFrame(
        [
            (1, 9, " Medical ", "10.005", day, "Approved ", None, datetime(2024, 1, 4, 23), datetime(2024, 1, 1)),
            (1, 9, "old", "1", day, "rejected", None, None, datetime(2023, 1, 1)),
            (2, 9, "x", "bad", day, None, "d", None, None),
            (3, 9, "x", "99999999999.00", day, "PENDING", "d", None, datetime(2024, 1, 1)),
        ],
        CLAIMS,
    )
    rows = {r["claim_id"]: r for r in silver.claims(raw).collect()}
    assert (rows[1]["claim_type"], rows[1]["claim_amount"], rows[1]["days_to_process"], rows[1]["is_approved"]) == (
        "medical", Decimal("10.01"), 3, True,
    )
    assert (rows[2]["claim_amount"], rows[2]["days_to_process"], rows[2]["is_approved"]) == (None, None, False)
    assert rows[3]["claim_amount"] is None


def test_text_times_are_parsed(spark):
    raw = spark.createDataFrame(
        [(1, 9, "a", "1", date(2024, 1, 1), "approved", None, "not a time", "2024-01-02T03:04:05Z")],
        CLAIMS.replace("processed_at timestamp_ntz, created_at timestamp_ntz", "processed_at string, created_at string"),
    )
    row = silver.claims(raw).first()
    assert row["created_at"] == datetime(2024, 1, 2, 3, 4, 5)
    assert row["processed_at"] is None and row["days_to_process"] is None


def test_brokers_latest_report_then_best_paid(spark):
    ddl = (
        "broker_id bigint, broker_name string, broker_company string, country string, "
        "policies_sold_today double, total_premium_value string, commission_rate double, "
        "commission_earned string, report_date date"
    )
    rows = [
        (1, " a ", " c ", " UK ", 12.5, "10.005", 0.1234, "5", date(2024, 1, 1)),
        (1, "b", "c", "UK", 1.0, "1", 0.1, "9", date(2024, 1, 1)),
        (1, "old", "c", "UK", 1.0, "1", 0.1, "99", date(2023, 1, 1)),
        (2, " a ", " c ", " UK ", 12.5, "10.005", 0.1234, "5", date(2024, 1, 1)),
    ]
    got = {r["broker_id"]: r for r in silver.brokers(spark.createDataFrame(rows, ddl)).collect()}
    assert got[1]["broker_name"] == "b"
    assert (got[2]["policies_sold_today"], got[2]["total_premium_value"], got[2]["commission_percentage"]) == (
        13, Decimal("10.01"), Decimal("12.34"),
    )


def test_flights_without_callsign_go(spark):
    raw = spark.createDataFrame([flight("a", 1, call="  "), flight("b", 1, call=" X "), flight("c", 1, call=None)], FLIGHTS)
    rows = silver.flights(bronze.clean_flights(raw, NOW)).collect()
    assert [(r["icao24"], r["callsign"], r["on_ground"]) for r in rows] == [("b", "X", True)]


def test_refresh_computes_only_days_with_new_rows(spark, folder):
    landed = datetime(2024, 1, 2, 1)

    def at(icao, day, second, arrived):
        row = list(flight(icao, second))
        row[9] = None if day is None else datetime(2024, 1, day, 0, 0, second)
        row[10] = arrived
        return tuple(row)

    first = [at("a", 1, 1, landed), at("b", 2, 1, landed), at("c", None, 1, landed)]
    run1, run2 = datetime(2024, 1, 2, 6), datetime(2024, 1, 3, 6)
    bronze.refresh_flights(spark.createDataFrame(first, FLIGHTS), folder, run1)
    grown = [*first, at("a", 2, 2, datetime(2024, 1, 2, 7)), at("c", None, 2, datetime(2024, 1, 2, 8))]
    raw = spark.createDataFrame(grown, FLIGHTS)
    bronze.refresh_flights(raw, folder, run2)
    stored = bronze.read_clean_flights(raw, folder)
    whole = bronze.clean_flights(raw, run2)
    assert sorted(map(repr, stored.drop("ingested_at").collect())) == sorted(map(repr, whole.drop("ingested_at").collect()))
    stamps = {(r["icao24"], r["event_timestamp"] and r["event_timestamp"].day): r["ingested_at"] for r in stored.collect()}
    assert stamps == {("a", 1): run1, ("b", 2): run2, ("a", 2): run2, ("c", None): run2}
    stats = bronze.read_flight_stats(spark, folder)
    assert sorted(map(repr, stats.collect())) == sorted(map(repr, bronze.flight_daily_stats(whole).collect()))


def test_refresh_repeats_a_run_that_was_cut_short(spark, folder, monkeypatch):
    raw = spark.createDataFrame([flight("a", 1)], FLIGHTS)
    bronze.refresh_flights(raw, folder, NOW)
    grown = raw.union(spark.createDataFrame([flight("b", 1)], FLIGHTS))
    with monkeypatch.context() as patch:
        patch.setattr(bronze, "_stats_by_day", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
        try:
            bronze.refresh_flights(grown, folder, datetime(2025, 1, 1, 1))
        except RuntimeError:
            pass
    assert bronze.read_flight_stats(spark, folder).first()["flight_count"] == 1
    bronze.refresh_flights(grown, folder, datetime(2025, 1, 9))
    assert bronze.read_flight_stats(spark, folder).first()["flight_count"] == 2


def test_refresh_drops_a_day_that_lost_its_last_row(spark, folder):
    first = flight("a", 1)
    later = flight("a", 2, lat=None)  # newer, in the same bucket, without a position
    bronze.refresh_flights(spark.createDataFrame([first], FLIGHTS), folder, NOW)
    raw = spark.createDataFrame([first, later], FLIGHTS)
    assert bronze.read_clean_flights(raw, folder).count() == 1
    bronze.refresh_flights(raw, folder, datetime(2025, 1, 2))
    assert bronze.read_clean_flights(raw, folder).count() == 0
    assert bronze.read_flight_stats(spark, folder).count() == 0


def test_refresh_reads_only_the_touched_days(spark, folder):
    spark.createDataFrame([flight("a", 1)], FLIGHTS).write.parquet(f"{folder}/raw")
    days = spark.createDataFrame([(date(2024, 1, 1),), (None,)], f"{bronze.DAY} date")
    raw = spark.read.parquet(f"{folder}/raw").withColumn("event_day", F.to_date("event_timestamp"))
    raw.write.partitionBy("event_day").parquet(f"{folder}/by_day")
    plan = plan_of(bronze._on_days(spark.read.parquet(f"{folder}/by_day"), F.col("event_day"), days))
    assert "PartitionFilters: [(isnull(event_day" in plan and "2024-01-01" in plan


def test_refresh_of_many_days_keeps_the_stamps_of_others(spark, folder):
    """More than a year of days in one batch, one of them without a position, none rebuilt in passing."""
    def on(day, arrived, lat=1.0, icao="a"):
        row = list(flight(icao, 1, lat=lat))
        row[9], row[10] = datetime(2020, 1, 1, 0, 0, 1) + timedelta(days=day), arrived
        return tuple(row)

    run1, run2 = datetime(2024, 1, 2), datetime(2024, 1, 5)
    first = [on(d, datetime(2024, 1, 1)) for d in range(3)]
    raw = spark.createDataFrame(first, FLIGHTS)
    bronze.refresh_flights(raw, folder, run1)
    later = [on(d, datetime(2024, 1, 4)) for d in range(2, 372)] + [on(400, datetime(2024, 1, 4), None)]
    raw = raw.union(spark.createDataFrame(later, FLIGHTS))
    bronze.refresh_flights(raw, folder, run2)
    stored = bronze.read_clean_flights(raw, folder)
    assert stored.count() == 372 and bronze.read_flight_stats(spark, folder).count() == 372
    old = stored.filter(F.col("ingested_at") == F.lit(run1)).select("event_timestamp").collect()
    assert sorted(r["event_timestamp"].day for r in old) == [1, 2]
