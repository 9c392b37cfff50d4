from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake.operators.latest import latest_per_key


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_ties_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [
            (1, 5, "a"), (1, 5, "b"), (1, None, "z"),  # tie on the order column, unknown order
            (None, 1, "x"), (None, 2, "y"),  # NULL keys are one group
            (3, None, "only"),
        ],
        "k bigint, t bigint, v string",
    )
    key = lambda r: (r[0] is None, r[0])
    known = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["t"]).collect()), key=key)
    assert known == [(1, 5, "b"), (3, None, "only"), (None, 2, "y")]
    unknown = latest_per_key(df, ["k"], ["t"], unknown_first=True)
    assert sorted((tuple(r) for r in unknown.collect()), key=key)[0] == (1, None, "z")


def test_same_survivor_for_any_partitioning(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 97).alias("k"), (F.col("id") % 5).alias("t"), F.xxhash64("id").alias("v")
    )
    expected = rows_of(latest_per_key(df, ["k"], ["t"]))
    assert rows_of(latest_per_key(df.repartition(13), ["k"], ["t"])) == expected
    assert rows_of(latest_per_key(df.orderBy("v"), ["k"], ["t"])) == expected
    assert len(expected) == 97


def test_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = plan_of(latest_per_key(df, ["k"], ["t"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_one_key_with_a_third_of_the_rows_ships_one_row_per_task(spark):
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = latest_per_key(df, ["k"], ["t"])
    assert latest.count() == 60_001
    assert latest.filter("k = -1").first()["t"] == 89_997
