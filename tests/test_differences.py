from __future__ import annotations

import random

import pytest

from tests.conftest import plan_of
from wanderlake.plans import reconcile

ROW = "id bigint, name string, amount decimal(10,2)"
SPANS = (100, 10)


def rows(spark, data, schema=ROW):
    return spark.createDataFrame(data, schema)


def ranges(source, target, **options):
    found = reconcile.differing_ranges(source, target, "id", spans=SPANS, **options).collect()
    return sorted(((r["range_start"], r["source_rows"], r["target_rows"]) for r in found), key=str)


def differences(source, target, **options):
    found = reconcile.differing_rows(source, target, "id", spans=SPANS, **options).collect()
    return {r["id"]: (r["status"], r["source_rows"], r["target_rows"], r["differing_columns"]) for r in found}


def test_equal_tables_in_any_order_do_not_differ(spark):
    data = [(i, f"n{i}", None) for i in range(50)] + [(None, None, None)] * 2 + [(7, "n7", None)]
    shuffled = random.Random(3).sample(data, len(data))
    assert ranges(rows(spark, data), rows(spark, shuffled)) == []
    assert differences(rows(spark, data), rows(spark, shuffled)) == {}


def test_only_planted_ranges_are_named_when_counts_agree(spark):
    data = [(i, f"n{i}", None) for i in range(1000)]
    other = [(i, "x" if i == 123 else f"n{i}", None) for i in range(1000) if i != 555] + [(1777, "new", None)]
    source, target = rows(spark, data), rows(spark, other)
    assert source.count() == target.count()
    assert ranges(source, target) == [(120, 10, 10), (1770, 0, 1), (550, 10, 9)]
    assert differences(source, target) == {
        123: ("changed", 1, 1, ["name"]), 555: ("missing", 1, 0, []), 1777: ("unexpected", 0, 1, []),
    }


def test_values_that_change_places_differ(spark):
    source = rows(spark, [(1, None, 1), (2, "a", 1)], "id bigint, one string, two int")
    target = rows(spark, [(1, "a", 1), (2, None, 1)], "id bigint, one string, two int")
    assert differences(source, target) == {1: ("changed", 1, 1, ["one"]), 2: ("changed", 1, 1, ["one"])}
    beside = "id bigint, one string, two string"
    assert differences(rows(spark, [(1, None, "a")], beside), rows(spark, [(1, "a", None)], beside))[1][3] == ["one", "two"]


def test_repeats_and_missing_keys_count(spark):
    source = rows(spark, [(1, "a", None), (1, "a", None), (None, "b", None), (-5, "c", None)])
    target = rows(spark, [(1, "a", None), (None, "b", None), (None, "d", None), (-5, "e", None)])
    assert ranges(source, target) == [(-10, 1, 1), (0, 2, 1), (None, 1, 2)]
    assert differences(source, target) == {
        1: ("missing", 1, 0, []), None: ("unexpected", 0, 1, []), -5: ("changed", 1, 1, ["name"]),
    }


def test_only_missing_keys_differ(spark):
    source, target = rows(spark, [(1, "a", None), (None, "b", None)]), rows(spark, [(1, "a", None)])
    assert differences(source, target) == {None: ("missing", 1, 0, [])}


@pytest.mark.parametrize("filled", ["source", "target", "none"])
def test_empty_tables(spark, filled):
    some, empty = rows(spark, [(3, "a", None)]), rows(spark, [])
    source, target = (some if filled == "source" else empty), (some if filled == "target" else empty)
    expected = {"source": {3: ("missing", 1, 0, [])}, "target": {3: ("unexpected", 0, 1, [])}, "none": {}}
    assert differences(source, target) == expected[filled]


def test_chosen_and_common_columns(spark):
    source = rows(spark, [(1, "a", None)])
    target = rows(spark, [(1, "b", None, 9)], f"{ROW}, extra int")
    assert differences(source, target, columns=["amount"]) == {}
    assert differences(source, target)[1] == ("changed", 1, 1, ["name"])
    only_keys = rows(spark, [(1,), (2,)], "id bigint")
    assert differences(only_keys, source) == {2: ("missing", 1, 0, [])}


def test_types_are_brought_together(spark):
    source = rows(spark, [(1, 5)], "id int, amount int")
    assert differences(source, rows(spark, [(1, 5)], "id bigint, amount bigint")) == {}


def test_random_tables_against_brute_force(spark):
    chance = random.Random(11)
    for _ in range(2):
        source = {i: (i, chance.choice("ab"), None) for i in chance.sample(range(400), 150)}
        target = {i: r if chance.random() > 0.1 else (i, chance.choice("abc"), None) for i, r in source.items() if chance.random() > 0.05}
        target |= {i: (i, "z", None) for i in chance.sample(range(400, 600), 5)}
        expected = {}
        for key in source.keys() | target.keys():
            if key not in target:
                expected[key] = ("missing", 1, 0, [])
            elif key not in source:
                expected[key] = ("unexpected", 0, 1, [])
            elif source[key] != target[key]:
                expected[key] = ("changed", 1, 1, ["name"])
        assert differences(rows(spark, list(source.values())), rows(spark, list(target.values()))) == expected


def test_later_levels_read_differing_ranges_only(spark, folder):
    rows(spark, [(i, "a", None) for i in range(500)]).write.parquet(f"{folder}/source")
    rows(spark, [(i, "b" if i == 250 else "a", None) for i in range(500)]).write.parquet(f"{folder}/target")
    both = reconcile._both(spark.read.parquet(f"{folder}/source"), spark.read.parquet(f"{folder}/target"), "id", None)
    first = reconcile._stage(reconcile._sums(both, "id", 100), 100)
    plan = plan_of(reconcile._sums(reconcile._within(both, first, "id"), "id", 10))
    assert plan.count("GreaterThanOrEqual(id,200)") == 2 and plan.count("LessThan(id,300)") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
