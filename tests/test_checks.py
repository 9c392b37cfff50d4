from __future__ import annotations

from datetime import datetime, timedelta

from wanderlake.plans import monitor, quality, reconcile

NOW = datetime(2024, 6, 1, 12)


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, 1), (1, "b", 0, 9), (None, None, -1, None), (2, "zzz", None, 9)],
        "k bigint, s string, n int, fk bigint",
    )
    parents = spark.createDataFrame([(1,)], "id bigint")
    report = quality.run_checks(
        "t",
        df,
        [
            quality.NotNull("k"),
            quality.Unique("k"),
            quality.AcceptedValues("s", ["a", "b"]),
            quality.ExpressionIsTrue("n", "> 0"),
            quality.Relationship("fk", parents, "id"),
        ],
    )
    assert report.columns == list(quality.REPORT_COLUMNS)
    assert {(r["check_name"], r["failures"], r["status"]) for r in report.collect()} == {
        ("not_null", 1, "fail"), ("unique", 1, "fail"), ("accepted_values", 1, "fail"),
        ("expression_is_true", 2, "fail"), ("relationships", 2, "fail"),
    }
    empty = quality.run_checks("t", df.limit(0), [quality.NotNull("k"), quality.Unique("k")])
    assert {(r["failures"], r["status"]) for r in empty.collect()} == {(0, "pass")}


def test_non_positive(spark):
    df = spark.createDataFrame([(1, 0), (2, -1), (3, 1), (4, None)], "claim_id bigint, claim_amount int")
    assert sorted(r["claim_id"] for r in quality.non_positive_claims(df).collect()) == [1, 2]


def test_freshness_limits(spark):
    def aged(seconds):
        return spark.createDataFrame([(NOW - timedelta(seconds=seconds),)], "t timestamp_ntz"), "t"

    hour = 3600
    sources = {
        "h23": aged(23 * hour), "h24": aged(24 * hour), "h24s": aged(24 * hour + 1), "h47": aged(47 * hour),
        "h48": aged(48 * hour), "h48s": aged(48 * hour + 1),
        "empty": (spark.createDataFrame([], "t timestamp_ntz"), "t"),
    }
    status = {r["source_name"]: r["status"] for r in quality.freshness(sources, NOW).collect()}
    assert status == {
        "h23": "pass", "h24": "pass", "h24s": "warn", "h47": "warn", "h48": "warn", "h48s": "error", "empty": "error",
    }


def test_match_percentage(spark):
    cases = [(0, 0, 100.0, True), (0, 5, 0.0, False), (100, 95, 95.0, True), (100, 94, 94.0, False),
             (100, 250, 0.0, False), (3, 2, 66.67, False), (100, 105, 95.0, True)]
    df = spark.createDataFrame([c[:2] for c in cases], "source_count bigint, destination_count bigint")
    rows = reconcile.compare_counts(df).collect()
    assert [(r["source_count"], r["destination_count"], r["match_percentage"], r["passed"]) for r in rows] == cases
    assert [r["difference"] for r in rows][:3] == [0, 5, -5]


def test_reconcile_and_verdict(spark, folder):
    report = reconcile.reconcile({"a": (spark.range(10), spark.range(10)), "b": (spark.range(10), spark.range(5))})
    assert {r["table_name"]: r["passed"] for r in report.collect()} == {"a": True, "b": False}
    assert reconcile.verdict(report).first()["all_passed"] is False
    reconcile.write_report(report, f"{folder}/r")
    assert spark.read.json(f"{folder}/r").count() == 2


def test_gate(spark):
    def at(hours):
        return spark.createDataFrame([(NOW - timedelta(hours=hours),)], "created_at timestamp_ntz")

    cases = [(24, 25, (1, 0, True)), (25, 25, (0, 0, False)), (30, 1, (0, 1, True))]
    for policies, claims, expected in cases:
        assert tuple(monitor.source_activity(at(policies), at(claims), NOW).first()) == expected


def test_lag(spark):
    ddl = "partition int, low bigint, high bigint, committed bigint"
    rows = [(0, 5, 100, 40), (1, 5, 100, -1), (2, 0, 100, 130)]
    offsets = spark.createDataFrame(rows, ddl)
    assert {r["partition"]: r["lag"] for r in monitor.partition_lag(offsets).collect()} == {0: 60, 1: 95, 2: 0}
    assert tuple(monitor.stream_lag(offsets).first()) == (155, "healthy")
    assert tuple(monitor.stream_lag(spark.createDataFrame([(0, 0, 1001, 0)], ddl)).first()) == (1001, "high")
    assert tuple(monitor.stream_lag(spark.createDataFrame([(0, 0, 1000, 0)], ddl)).first()) == (1000, "healthy")


def test_landing(spark):
    df = spark.createDataFrame([(NOW - timedelta(minutes=30),), (NOW - timedelta(minutes=31),)], "ingested_at timestamp_ntz")
    assert tuple(monitor.landing_freshness(df, NOW).first()) == (1, "healthy")
    assert tuple(monitor.landing_freshness(df, NOW + timedelta(minutes=1)).first()) == (0, "warning")


def test_status_summary(spark):
    steps = monitor.run_status(spark, [("a", "success", ""), ("b", "failed", "x"), ("c", "upstream_failed", "")])
    assert tuple(monitor.status_summary(steps).first()) == (1, 1, False)
    assert monitor.status_summary(steps.filter("state = 'success'")).first()["succeeded"] is True
