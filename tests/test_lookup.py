from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake.operators.lookup import HotKeys, find_hot_keys, lookup, missing_parents, small_enough


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def skewed(spark, n=30_000):
    """A third of the rows on key 7, a third without a key, the rest spread."""
    kind = F.col("id") % 3
    return spark.range(n).select(
        F.col("id").alias("row"),
        F.when(kind == 0, F.lit(7)).when(kind == 1, F.col("id") % 5_000 + 100).alias("k"),
    )


def dimension(spark):
    return spark.range(4_000).select(F.col("id").alias("key"), F.concat(F.lit("d"), F.col("id")).alias("label"))


def test_hot_keys_are_found_and_bounded(spark):
    hot = find_hot_keys(skewed(spark), {"k": F.col("k"), "row": F.col("row")})
    assert hot.of("k") == [7]
    assert hot.nulls == {"k"}
    assert hot.of("row") == []
    assert hot.spread == 8


def test_salted_lookup_gives_the_plain_result(spark, no_broadcast):
    facts, table = skewed(spark), dimension(spark)
    hot = find_hot_keys(facts, {"k": F.col("k")})
    plain = lookup(facts, table, F.col("k"), "key")
    salted = lookup(facts, table, F.col("k"), "key", "k", hot, ["row"])
    assert salted.columns == plain.columns == ["row", "k", "label"]
    assert salted.count() == 30_000
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    assert "SortMergeJoin" in plan_of(salted)


def test_hot_rows_are_spread_over_partitions(spark, no_broadcast):
    facts = skewed(spark)
    hot = find_hot_keys(facts, {"k": F.col("k")})
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = lookup(facts, dimension(spark), F.col("k"), "key")
        salted = lookup(facts, dimension(spark), F.col("k"), "key", "k", hot, ["row"])

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(plain) > 10_000
        assert largest(salted) < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_only_nulls_hot(spark, no_broadcast):
    facts = spark.range(1_000).select(F.col("id").alias("row"), F.when(F.col("id") < 400, F.col("id")).alias("k"))
    hot = HotKeys({"k": []}, frozenset({"k"}), 8)
    joined = lookup(facts, dimension(spark), F.col("k"), "key", "k", hot, ["row"])
    assert joined.count() == 1_000
    assert joined.filter("label is null").count() == 600


def test_counted_table_is_broadcast_and_others_are_not_forced(spark, no_broadcast):
    facts, table = skewed(spark, 300), dimension(spark)
    assert small_enough(table, rows=4_000) and not small_enough(table, rows=3_999)
    assert "BroadcastHashJoin" in plan_of(lookup(facts, table, F.col("k"), "key", small=True))
    assert "BroadcastHashJoin" not in plan_of(lookup(facts, table, F.col("k"), "key"))


def test_missing_parents(spark):
    children = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "fk bigint")
    parents = spark.createDataFrame([(1,), (None,)], "id bigint")
    rows = missing_parents(children, "fk", parents, "id").collect()
    assert sorted(map(tuple, rows)) == [(2, 2), (3, 1)]


def test_few_facts_leave_the_large_table_where_it_is(spark, no_broadcast):
    facts, table = skewed(spark, 600), dimension(spark)
    joined = lookup(facts, table, F.col("k"), "key", few_facts=True)
    plain = lookup(facts, table, F.col("k"), "key")
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    plan = plan_of(joined)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
