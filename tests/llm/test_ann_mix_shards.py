from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.llm.conftest import DOCS, doc, prose
from wanderlake.llm import ann, mixing, sharding
from wanderlake.session import scratch_dir

SMALL = ann.Settings(block_rows=200, sample_rows=300, leaf_rows=16, queries_of_a_task=7)


def true_neighbours(rows, k=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for q in sorted({i for i in ids.tolist() if i % 20 == 0}):
        score = x @ x[np.flatnonzero(ids == q)[0]]
        other = np.flatnonzero(ids != q)
        out[q] = [(int(ids[i]), float(score[i])) for i in other[np.lexsort((ids[other], -score[other]))][:k]]
    return out


@pytest.mark.parametrize("shape", ["normal", "clusters", "lengths"])
def test_recall_against_brute_force(spark, shape):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1200, 24))
    if shape == "clusters":
        x = rng.normal(size=(10, 24))[rng.integers(0, 10, 1200)] + 0.3 * x
    if shape == "lengths":
        x = x * rng.uniform(0.1, 5, (1200, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = defaultdict(list)
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, settings=SMALL)
    for r in out.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    truth = true_neighbours(rows)
    assert set(found) == set(truth) and all(len(v) == 20 for v in found.values())
    hits = sum(len({a for a, _ in found[q]} & {a for a, _ in truth[q]}) for q in truth)
    assert hits >= 0.97 * 20 * len(truth)
    for q, near in found.items():
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)
        assert np.allclose([s for _, s in near], [float(np.dot(x[q], x[i])) for i, _ in near], rtol=1e-12)


def test_ties_go_to_the_smaller_id_and_odd_vectors_take_no_part(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(i, same) for i in range(0, 700)]
    rows += [(1000, None), (1020, []), (1040, [0.0, 0.0, 0.0]), (1060, [1.0, None, 2.0]), (1080, [1.0, float("nan"), 1.0]), (1100, [float("inf"), 1.0, 1.0]), (None, same)]
    rows += [(2000, [1.0, 1.0]), (2001, [1.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    found = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, settings=SMALL).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    for q in range(0, 700, 20):
        assert found[q] == [i for i in range(22) if i != q][:20]
    assert found[2000] == [2001] and max(found) == 2000
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square_quantile():
    assert ann.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)
    assert ann.chi_square_quantile(0.99, 2) == pytest.approx(9.210, abs=1e-3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 3)), max_size=5, unique_by=lambda x: x[0]), st.integers(0, 40))
def test_knapsack_comes_closest(items, budget):
    lengths, counts = [a for a, _ in items], [b for _, b in items]
    taken = mixing.fill(lengths, counts, budget)
    sums = {sum(a * b for a, b in zip(lengths, use)) for use in product(*(range(c + 1) for c in counts))}
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    assert sum(a * b for a, b in zip(lengths, taken)) == min(sums, key=lambda s: (abs(s - budget), s))


@pytest.mark.parametrize("lengths, target, taken", [
    ([100_000], 60_000, 100_000),
    ([100_000], 40_000, 0),
    ([100_000], 190_000, 200_000),
    ([45_000, 50_000, 60_000], 95_000, 95_000),
    ([700_000, 900_000, 1_000_000], 1_601_000, 1_600_000),
])
def test_long_documents_come_as_close_as_short_ones(lengths, target, taken):
    for scale in (1, 10, 1000):
        sizes, counts = np.array(lengths) // scale, np.ones(len(lengths), np.int64)
        copies, extra = mixing.plan_source(sizes, counts, target / scale)
        assert (sizes * (copies + extra)).sum() == taken // scale


def test_masks_of_very_long_documents_stay_bounded(monkeypatch):
    monkeypatch.setattr(mixing, "MASK_BITS", 1 << 12)
    sizes = np.array([300_000, 410_000, 520_000])
    copies, extra = mixing.plan_source(sizes, np.ones(3, np.int64), 715_000)
    assert copies == 0 and (sizes * extra).sum() == 710_000


@pytest.mark.parametrize("bits", [1 << 10, 1 << 13, 1 << 16])
def test_units_of_several_words_miss_by_a_bounded_number(monkeypatch, bits):
    """A document is off by less than a unit in either choice, and the target by half a unit."""
    rng = np.random.default_rng(bits)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 4_000, 12))
        unused = rng.integers(1, 4, len(lengths))
        gap = int(rng.integers(2_000, 15_000))
        monkeypatch.setattr(mixing, "MASK_BITS", 1 << 28)
        exact = mixing.refill(lengths, unused, gap)
        monkeypatch.setattr(mixing, "MASK_BITS", bits)
        coarse = mixing.refill(lengths, unused, gap)
        assert (0 <= coarse).all() and (coarse <= unused).all()
        able = (lengths <= 2 * gap) & (unused > 0)
        items = sum(int(min(n, 2 * gap // size)).bit_length() for n, size in zip(unused[able], lengths[able], strict=True))
        unit = -(-2 * gap * items // bits)
        nearest, found = (abs(gap - int((lengths * taken).sum())) for taken in (exact, coarse))
        assert nearest <= found
        if unit == 1:
            assert found == nearest
        assert found <= nearest + unit * (int(exact.sum()) + int(coarse.sum()) + 1)


def water_filled(sizes: dict) -> dict:
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while len(fixed) < len(order):
        open_sources = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in open_sources)
        over = [s for s in open_sources if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * level for s in open_sources}}
        fixed.update({s: 3.0 * sizes[s] for s in over})
    return fixed


def test_mix_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_OF_A_BUCKET", 50)
    rows = [doc(i, prose(i, 3 + i * 7 % 40), "en", "abcdefg"[min(6, i % 40)]) for i in range(1500)]
    rows += [doc(5000 + i, "same size text here", "en", "a") for i in range(700)] + [doc(9000, None, "en", "zero"), doc(9001, "one", "en", None), doc(9001, "one", "en", None)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(df, mixing.word_count("text")).collect()
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["copies"] <= 3 and r["kept"] == "x"
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(water_filled(sizes))
    assert all(r["source_size"] == sizes[r["source"]] for r in out)
    for s in sizes:
        lengths = {r["size"] for r in out if r["source"] == s and r["size"]}
        assert abs(taken[s] - target[s]) <= (min(lengths, default=0) if len(lengths) == 1 else 1), s
    again = mixing.mix(df.repartition(5), mixing.word_count("text")).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in out)
    assert mixing.repeated(mixing.mix(df, mixing.word_count("text")), ["doc_id"]).count() == sum(r["copies"] for r in out)


def test_mix_orders_ids_and_leaves_texts_in_place(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_OF_A_BUCKET", 20)
    rows = [(i, "w " * (1 + i % 3), "abc"[i % 5 % 3]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    mixed = mixing.mix(df, mixing.word_count("text"))
    plan = plan_of(mixed)
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan
    # Ids that many rows share, null among them, are cut within their rows.
    shared = spark.createDataFrame([(None if i % 4 == 0 else i % 3, *r[1:]) for i, r in enumerate(rows)], df.schema).repartition(7)
    for docs in (mixed, mixing.mix(shared, mixing.word_count("text"))):
        out = docs.collect()
        assert len(out) == 900
        for source in "abc":
            own = [r for r in out if r["source"] == source]
            assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 1
        lengths = {}
        for r in out:
            lengths.setdefault((r["source"], r["size"]), set()).add(r["copies"])
        assert all(max(c) - min(c) <= 1 for c in lengths.values())


def test_mix_edges(spark, edge_docs, no_docs):
    out = mixing.mix(edge_docs, mixing.word_count("text")).collect()
    assert len(out) == edge_docs.count() and all(r["copies"] == 0 for r in out if not r["size"])
    assert mixing.mix(no_docs, mixing.word_count("text")).count() == 0
    empty = spark.createDataFrame([doc(1, None), doc(2, "")], DOCS)
    assert {r["target"] for r in mixing.mix(empty, mixing.word_count("text")).collect()} == {0.0}


def test_flow_ships_everything_and_moves_the_least():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = {i: int(rng.integers(0, 1000)) for i in rng.choice(12, 7, replace=False).tolist()}
        capacities = sharding.even_capacities(sum(sizes.values()), 9)
        flows = sharding.min_cost_flow(sizes, capacities)
        for i, s in sizes.items():
            assert sum(n for (a, _), n in flows.items() if a == i) == s
        for j, c in enumerate(capacities):
            assert sum(n for (_, b), n in flows.items() if b == j) == c
        least = sum(s - min(s, capacities[i] if i < 9 else 0) for i, s in sizes.items())
        assert sum(n for (a, b), n in flows.items() if a != b) == least
    with pytest.raises(ValueError):
        sharding.min_cost_flow({0: 5}, [4])


def resharded(spark, df, old, shards, capacities=None):
    layout = sharding.lay_out(df, old, scratch_dir(spark, "shards-test"), shards)
    plan = sharding.plan_transfers(layout, shards, capacities)
    sharding.rewrite(spark, layout, plan)
    return layout, plan, sharding.read_shards(spark, layout, plan)


def size_of(text):
    return len((text or "").encode()) + 8


@pytest.mark.parametrize("rows_of_a_block, bytes_of_a_block", [(40, 1 << 20), (8192, 5000), (8192, 1 << 25)])
def test_reshard(spark, monkeypatch, rows_of_a_block, bytes_of_a_block):
    monkeypatch.setattr(sharding, "ROWS_OF_A_BLOCK", rows_of_a_block)
    monkeypatch.setattr(sharding, "BYTES_OF_A_BLOCK", bytes_of_a_block)
    rows = [doc(i, prose(i, 5 + i % 30), "en", "abc"[min(2, i % 9)]) for i in range(900)] + [doc(2000, None), doc(2000, None), doc(None, "same"), doc(None, "same"), doc(3000, prose(1, 800))]
    df = spark.createDataFrame(rows, DOCS)
    _, plan, out = resharded(spark, df, (F.ascii("source") - 97).cast("int"), 7)
    assert plan.rewritten == [2]
    found = out.collect()
    assert out.columns[: len(df.columns)] == df.columns and {r["size"] for r in found} == {"x"}
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in found) == sorted((str(r[0]), str(r[1])) for r in rows)
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["_wl_shard"]].append((r["_wl_slot"], size_of(r["text"])))
    assert set(by_shard) == set(range(7))
    totals = {s: sum(n for _, n in v) for s, v in by_shard.items()}
    assert max(totals.values()) - min(totals.values()) < 1500
    for v in by_shard.values():
        assert sorted(slot for slot, _ in v) == list(range(len(v)))


def test_only_affected_shards_are_written(spark):
    rows = [doc(i, "x" * 100, "en", "abcd"[i % 4]) for i in range(400)] + [doc(1000 + i, "x" * 100, "en", "a") for i in range(100)]
    df = spark.createDataFrame(rows, DOCS)
    capacity = [108 * 100, 108 * 200, 108 * 100, 108 * 100]
    layout, plan, out = resharded(spark, df, (F.ascii("source") - 97).cast("int"), 4, capacity)
    assert plan.rewritten == [0] and plan.moved_bytes == 108 * 100
    new = spark.read.parquet(f"{layout.folder}/new")
    assert {(r["_wl_new"], r["count"]) for r in new.groupBy("_wl_new").count().collect()} == {(0, 100), (1, 100)}
    found = defaultdict(list)
    for r in out.collect():
        found[r["_wl_shard"]].append(r["_wl_slot"])
    assert {s: sorted(v) for s, v in found.items()} == {0: [*range(100)], 1: [*range(200)], 2: [*range(100)], 3: [*range(100)]}
    # What stood in a shard keeps its slot.
    before = {r["doc_id"]: (r["_wl_old"], r["_wl_slot"]) for r in sharding._old_rows(spark, layout).collect()}
    kept = [r for r in out.collect() if r["_wl_shard"] == before[r["doc_id"]][0]]
    assert len(kept) == 400 and all((r["_wl_shard"], r["_wl_slot"]) == before[r["doc_id"]] for r in kept)


def test_nothing_moves_where_nothing_has_to(spark):
    rows = [doc(i, "x" * 50, "en", "ab"[i % 2]) for i in range(40)]
    layout, plan, out = resharded(spark, spark.createDataFrame(rows, DOCS), (F.ascii("source") - 97).cast("int"), 2)
    assert plan.rewritten == [] and out.count() == 40 and plan.moved_bytes == 0


def test_equal_texts_stay_together_on_24_shards(spark):
    """The query's laws: near equal bytes, gapless slots, equal texts in one shard unless one group is large."""
    copies = [(10_000 + 40 * i + j, prose(5_000 + i, 30)) for i in range(60) for j in range(2 + i % 4)]
    rows = [(i, prose(i, 20 + i % 60)) for i in range(6_000)] + copies + [(90_000 + i, prose(77, 40)) for i in range(1_500)] + [(95_000 + i, None) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(24))
    _, plan, out = resharded(spark, df, old, 24)
    found = out.collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in found) == sorted((i, t or "") for i, t in rows)
    totals, slots, shards_of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in found:
        totals[r["_wl_shard"]] += size_of(r["text"])
        slots[r["_wl_shard"]].append(r["_wl_slot"])
        shards_of[r["text"] or ""].add(r["_wl_shard"])
    assert set(totals) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(totals.values()) / 24
    assert all(abs(n - mean) < 0.02 * mean for n in totals.values())
    assert len(shards_of.pop(prose(77, 40))) > 1 and all(len(s) == 1 for s in shards_of.values())
    assert 0 < len(plan.rewritten) < 24


def test_shard_edges(spark, edge_docs, no_docs):
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(3)).cast("int")
    assert resharded(spark, edge_docs, old, 3)[2].count() == edge_docs.count()
    assert resharded(spark, edge_docs, F.lit(None), 2)[2].count() == edge_docs.count()
    assert resharded(spark, edge_docs, old + 5, 2)[2].select("_wl_shard").distinct().count() == 2
    assert resharded(spark, no_docs, old, 3)[2].count() == 0
    crc = edge_docs.select("text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c")).collect()
    assert all(r["c"] == zlib.crc32((r["text"] or "").encode()) for r in crc)


def test_query_on_an_empty_table(spark, tmp_path):
    from wanderlake.llm.queries import QUERIES

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op6_shards"](spark, str(tmp_path)).collect() == []
