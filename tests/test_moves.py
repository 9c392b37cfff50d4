"""How often, and in what form, rows are moved and stored on their way into the stored tables."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake.functions.text import packed_key, unpacked_key
from wanderlake.operators import upsert as module
from wanderlake.operators.lookup import lookup
from wanderlake.operators.upsert import RANGE, chosen, merged, range_of, read_keyed, upsert
from wanderlake.plans import quality, star
from wanderlake.registry import queries as registry

DDL = "id bigint, customer_sk string, v string"


def key_of(value) -> str:
    return hashlib.md5(str(value).encode()).hexdigest()


def ranged(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl).withColumn(RANGE, range_of(F.col("id"), 10))


def rows_of(df):
    return sorted((tuple(r) for r in df.drop(RANGE).collect()), key=repr)


def test_every_text_survives_packing_and_keys_take_sixteen_bytes(spark):
    texts = [key_of(1), key_of(1).upper(), "", "a", "0123456789abcdef", "é" * 16, "g" * 32, "0" * 33, "0" * 31, "\x00" * 16, None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string").select("n", "t", packed_key(F.col("t")).alias("p"))
    found = rows.select("n", "t", unpacked_key(F.col("p")).alias("back"), F.length("p").alias("size")).orderBy("n").collect()
    assert [r["back"] for r in found] == texts
    assert [r["n"] for r in found if r["size"] == 16] == [0]


def test_packing_decodes_a_key_once_and_encodes_nothing(spark):
    plan = spark.createDataFrame([("a",)], "t string").select(packed_key(F.col("t")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unhex(") == 1 and plan.replace("unhex(", "").count("hex(") == 0


def test_surrogate_keys_are_moved_as_bytes(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "id bigint, v string")
    table = spark.createDataFrame([(1, key_of(1)), (2, "odd")], "natural bigint, customer_sk string")
    joined = lookup(facts, table, F.col("id"), "natural")
    assert sorted((r["v"], r["customer_sk"]) for r in joined.collect()) == [("x", key_of(1)), ("y", "odd"), ("z", None)]
    assert "unhex" in plan_of(joined)
    laid = module._gathered(ranged(spark, [(1, key_of(1), "a"), (2, "odd", "b"), (None, None, "c")]))
    assert rows_of(laid) == sorted([(1, key_of(1), "a"), (2, "odd", "b"), (None, None, "c")], key=repr)
    assert "unhex" in plan_of(laid)


@pytest.mark.parametrize("match_null", [False, True])
def test_a_merge_moves_stored_rows_once(spark, match_null):
    target = ranged(spark, [(1, key_of(1), "a"), (2, key_of(2), "b"), (25, "odd", "c"), (None, None, "d")])
    updates = ranged(spark, [(2, key_of(7), "B"), (30, key_of(3), "e"), (30, key_of(3), "e2"), (None, None, "D")])
    rows = merged(target, updates, "id", match_null)
    kept = [(1, key_of(1), "a"), (25, "odd", "c")] + ([] if match_null else [(None, None, "d")])
    new = [(2, key_of(7), "B"), (30, key_of(3), "e"), (30, key_of(3), "e2"), (None, None, "D")]
    assert rows_of(rows) == sorted(kept + new, key=repr)
    plan = plan_of(rows)
    assert "Join" not in plan
    # One for rows with a key; those without are laid out by another.
    assert plan.count("Exchange hashpartitioning") == (1 if match_null else 2)


def test_a_choice_moves_stored_rows_once(spark):
    target = ranged(spark, [(1, None, "a"), (2, None, "b"), (None, None, "d")])
    updates = ranged(spark, [(2, None, "a"), (1, None, "c"), (None, None, "D")])

    def largest(both):
        return module.latest_per_key(both, [RANGE, "id"], ["v"])

    rows = chosen(target, updates, "id", True, largest)
    assert rows_of(rows) == sorted([(1, None, "c"), (2, None, "b"), (None, None, "d")], key=repr)
    assert plan_of(rows).count("Exchange hashpartitioning") == 1
    assert rows_of(chosen(target, updates, "id", False, largest)) == sorted(
        [(1, None, "c"), (2, None, "b"), (None, None, "D"), (None, None, "d")], key=repr
    )


def test_a_delta_is_written_once(spark, folder, monkeypatch):
    first = spark.createDataFrame([(1, key_of(1), "a"), (2, key_of(2), "b")], DDL)
    upsert(first, f"{folder}/t", "id", known_unique=True)

    def fail(*_):
        raise AssertionError("a delta needs no copy of its batch")

    monkeypatch.setattr(module, "scratch_dir", fail)
    upsert(spark.createDataFrame([(2, key_of(3), "B")], DDL), f"{folder}/t", "id", known_unique=True, deltas=True)
    assert rows_of(read_keyed(spark, f"{folder}/t")) == sorted([(1, key_of(1), "a"), (2, key_of(3), "B")], key=repr)


def test_claims_are_built_for_those_who_read_them(spark, monkeypatch):
    built = []
    monkeypatch.setattr(registry, "bronze_tables", lambda *_: {})
    monkeypatch.setattr(registry.fixtures, "raw_claims", lambda *_: None)
    monkeypatch.setattr(star, "build_policies", lambda *_: built.append("policies"))
    monkeypatch.setattr(star, "update_claims", lambda *_: built.append("claims"))
    root = registry.star_root(spark, "/nowhere/star", ["fact_policies"])
    assert built == ["policies"]
    assert registry.star_root(spark, "/nowhere/star") == registry.star_root(spark, "/nowhere/star", ["fact_claims"]) == root
    assert built == ["policies", "claims"]


def test_the_stored_quality_report_is_read_without_another_build(spark, folder, monkeypatch):
    line = [("fact_claims", "unique", "claim_id", 2, "fail")]
    spark.createDataFrame(line, quality.REPORT_SCHEMA).write.json(f"{folder}/lake/reports/quality")
    monkeypatch.setattr(registry, "daily_root", lambda *_: folder)
    monkeypatch.setattr(registry, "star_root", lambda *_: pytest.fail("the star schema is not needed"))
    assert [tuple(r) for r in registry.daily_run_quality(spark, "/nowhere").collect()] == line


def test_the_declared_schema_is_that_of_the_report(spark):
    rows = spark.createDataFrame([(1, 1)], "a bigint, b bigint")
    report = quality.run_checks("t", rows, [quality.NotNull("a"), quality.Unique("a"), quality.Relationship("a", rows, "b")])
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], quality.REPORT_SCHEMA).schema]
