from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake import schemas
from wanderlake.operators import colocated
from wanderlake.operators import upsert as keyed
from wanderlake.operators.lookup import HotKeys, lookup
from wanderlake.operators.upsert import read_keyed, upsert
from wanderlake.plans import gold, link_store, star
from wanderlake.registry import queries as registry

SF = "/root/testdata/sf0.001"
LINK = "id bigint, name string"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def links(spark, rows, schema=LINK):
    return spark.createDataFrame(rows, schema)


def content(spark, path):
    return {r["id"]: r["name"] for r in colocated.read(spark, path).collect()}


def test_newest_load_wins_and_keys_without_value_are_left_out(spark, folder):
    assert colocated.read(spark, folder) is None
    colocated.append(links(spark, [(1, "a"), (2, "b"), (None, "z")]), folder, "id", 4, ["x"])
    assert content(spark, folder) == {1: "a", 2: "b"}
    colocated.append(links(spark, [(2, None), (3, "c")]), folder, "id", 4, ["x", "y"])
    assert content(spark, folder) == {1: "a", 2: None, 3: "c"}
    assert colocated.read_links(spark, folder)[1].covers == {"x", "y"}


def test_every_load_has_at_most_one_file_a_bucket(spark, folder):
    colocated.append(spark.range(1000).selectExpr("id", "cast(id as string) AS name"), folder, "id", 4)
    files = [f.name for f in Path(folder, "loads").rglob("*.parquet")]
    assert len(files) == 4 and len({f.split("_")[-1] for f in files}) == 4


def test_another_layout_is_refused(spark, folder):
    colocated.append(links(spark, [(1, "a")]), folder, "id", 4)
    with pytest.raises(colocated.OtherLayout):
        colocated.append(links(spark, [(1, "a")]), folder, "id", 8)
    with pytest.raises(colocated.OtherLayout):
        colocated.append(links(spark, [(1, 2)], "id bigint, name int"), folder, "id", 4)
    assert content(spark, folder) == {1: "a"}


def test_compaction_keeps_the_rows_and_later_loads(spark, folder, monkeypatch):
    for i in range(3):
        colocated.append(links(spark, [(i, "old"), (9, str(i))]), folder, "id", 4, [str(i)])
    before = content(spark, folder)
    assert not colocated.compact(spark, folder, most_loads=3)
    write = colocated._write

    def meanwhile(rows, path, key, buckets):
        load = write(rows, path, key, buckets)
        monkeypatch.setattr(colocated, "_write", write)
        colocated.append(links(spark, [(9, "late")]), path, "id", 4, ["late"])
        return load

    monkeypatch.setattr(colocated, "_write", meanwhile)
    assert colocated.compact(spark, folder, most_loads=2, grace=timedelta(0))
    assert content(spark, folder) == {**before, 9: "late"}
    _, said = colocated.read_links(spark, folder)
    assert len(said.loads) == 2 and said.covers == {"late"}
    # The manifest before still names the three merged loads.
    assert len(list(Path(folder, "loads").glob("load=*"))) == 5
    colocated.compact(spark, folder, most_loads=1, grace=timedelta(0))
    assert content(spark, folder) == {**before, 9: "late"}
    assert len(list(Path(folder, "loads").glob("load=*"))) == 3


def test_a_load_cut_short_is_not_read(spark, folder):
    colocated.append(links(spark, [(1, "a")]), folder, "id", 4)
    colocated._write(links(spark, [(1, "half")]), folder, "id", 4)
    assert content(spark, folder) == {1: "a"}


def facts(spark, n=20_000):
    kind = F.col("id") % 3
    key = F.when(kind == 0, F.lit(7)).when(kind == 1, F.col("id") % 5_000 + 100)
    return spark.range(n).select(F.col("id").alias("row"), key.alias("k"))


@pytest.mark.parametrize("hot", [HotKeys({"t": [7]}, frozenset({"t"}), 8), HotKeys()])
@pytest.mark.parametrize("loads", [1, 2])
def test_lookup_moves_the_facts_alone(spark, folder, no_broadcast, hot, loads):
    table = spark.range(4_000).selectExpr("id", "concat('d', id) AS name")
    colocated.append(table, folder, "id", 8)
    if loads == 2:
        newer = spark.range(5, 50).selectExpr("id", "CASE WHEN id = 7 THEN 'hot' END AS name")
        colocated.append(newer, folder, "id", 8)
        table = table.join(newer, "id", "left_anti").unionByName(newer)
    joined = lookup(facts(spark), colocated.read(spark, folder), F.col("k"), "id", "t", hot, ["row"], colocated=True)
    plan = plan_of(joined)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "__place" in plan.split("Exchange hashpartitioning")[1].split("\n")[0]
    assert plan.count("SortMergeJoin") == 1
    plain = facts(spark).join(table, F.col("k") == F.col("id"), "left").select("row", "k", "name")
    assert joined.columns == ["row", "k", "name"]
    assert joined.exceptAll(plain).isEmpty() and joined.count() == plain.count()
    if hot.values:
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2 * 20_000 / 8


def test_facts_set_apart_match_no_other_key(spark, folder, no_broadcast):
    # The place of the fact without a key is a key of the table.
    place = spark.range(1).select(F.xxhash64(F.lit(5).cast("bigint"))).first()[0]
    colocated.append(links(spark, [(place, "wrong"), (1, "a")]), folder, "id", 4)
    some = spark.createDataFrame([(5, None), (6, 1), (7, 1)], "row bigint, k bigint")
    for values in ([], [1]):
        joined = lookup(some, colocated.read(spark, folder), F.col("k"), "id", "t", HotKeys({"t": values}), ["row"], colocated=True)
        assert sorted(tuple(r) for r in joined.collect()) == [(5, None, None), (6, 1, "a"), (7, 1, "a")]


def policies(spark, rows):
    columns = list(schemas.FACT_POLICIES)
    full = [tuple({"policy_id": key, "customer_sk": name}.get(c) for c in columns) for key, name in rows]
    return spark.createDataFrame(full, schemas.ddl(schemas.FACT_POLICIES))


def test_links_follow_the_fact_and_read_changed_ranges_only(spark, folder, monkeypatch):
    copied = []
    read = link_store.read_ranges
    monkeypatch.setattr(link_store, "read_ranges", lambda s, p, entries: copied.append(set(entries)) or read(s, p, entries))

    def load(rows, **options):
        upsert(policies(spark, rows), f"{folder}/fact_policies", "policy_id", keys_per_range=10, **options)

    def linked():
        found = link_store.policy_links(spark, folder, 4)
        assert found.columns == ["policy_id", *gold.INHERITED]
        stored = read_keyed(spark, f"{folder}/fact_policies").filter("policy_id IS NOT NULL").select(found.columns)
        assert found.exceptAll(stored).isEmpty() and found.count() == stored.count()
        return {r["policy_id"]: r["customer_sk"] for r in found.collect()}

    assert link_store.policy_links(spark, folder, 4) is None
    load([(1, "a"), (12, "b"), (25, "c"), (None, "n")])
    assert linked() == {1: "a", 12: "b", 25: "c"}
    assert linked() == {1: "a", 12: "b", 25: "c"}
    load([(12, "B"), (13, "d")])
    assert linked() == {1: "a", 12: "B", 13: "d", 25: "c"}
    load([(1, "A"), (31, "e")], deltas=True)
    assert linked()[1] == "A"
    keyed.compact(spark, f"{folder}/fact_policies")
    for i in range(8):
        load([(25, str(i))])
        assert linked() == {1: "A", 12: "B", 13: "d", 25: str(i), 31: "e"}
    assert copied[:4] == [{0, 1, 2}, {1}, {0, 3}, {0, 2}]
    assert all(c == {2} for c in copied[4:])
    assert len(colocated.read_links(spark, f"{folder}/links/fact_policies")[1].loads) <= colocated.MOST_LOADS


def test_claims_of_a_large_batch_find_their_policies_in_the_links(spark, folder, monkeypatch):
    raw = registry.bronze_tables(spark, SF)
    monkeypatch.setattr(star, "small_enough", lambda table: False)
    star.build_dimensions(raw, folder, registry.AS_OF)
    star.update_policies(raw["raw_policies"], folder)
    used = []
    plain = gold.fact_claims
    monkeypatch.setattr(gold, "fact_claims", lambda *a, **o: used.append(o.get("colocated")) or plain(*a, **o))
    star.update_claims(raw["raw_claims"], folder, link_buckets=4)
    assert used == [True]
    found = star.read_gold_table(spark, folder, "fact_claims")
    expected = registry.fact_claims(spark, SF)
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()


def test_of_a_range_with_new_deltas_only_these_are_copied(spark, folder, monkeypatch):
    copied = []
    append = colocated.append

    def noting(rows, *rest):
        copied.append({(r["policy_id"], r["customer_sk"]) for r in rows.collect()})
        append(rows, *rest)

    monkeypatch.setattr(colocated, "append", noting)

    def load(rows):
        upsert(policies(spark, rows), f"{folder}/fact_policies", "policy_id", keys_per_range=10, deltas=True)

    def linked():
        return {r["policy_id"]: r["customer_sk"] for r in link_store.policy_links(spark, folder, 4).collect()}

    load([(1, "a"), (2, "b"), (12, "c"), (None, "n")])
    assert linked() == {1: "a", 2: "b", 12: "c"}
    load([(1, "A"), (3, "d"), (None, "m")])
    assert linked() == {1: "A", 2: "b", 3: "d", 12: "c"}
    load([(1, "B"), (4, "e")])
    load([(4, "E"), (13, "f")])
    assert linked() == {1: "B", 2: "b", 3: "d", 4: "E", 12: "c", 13: "f"}
    assert copied[1:] == [{(1, "A"), (3, "d")}, {(1, "B"), (4, "E"), (13, "f")}]
