from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wanderlake.operators import upsert as module
from wanderlake.operators.upsert import (
    RANGE,
    DuplicateKeys,
    read_keyed,
    read_manifest,
    upsert,
    watermark,
)

DDL = "id bigint, v string, created_at timestamp_ntz"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def test_insert_replace_and_repeat(spark, folder):
    path = f"{folder}/t"
    assert read_keyed(spark, path) is None
    upsert(frame(spark, [(1, "a", T1), (2, "b", T1), (3, "c", None)]), path, "id")
    batch = frame(spark, [(2, "B", T2), (4, "d", T2)])
    upsert(batch, path, "id")
    expected = rows_of(frame(spark, [(1, "a", T1), (2, "B", T2), (3, "c", None), (4, "d", T2)]))
    assert rows_of(read_keyed(spark, path)) == expected
    upsert(batch, path, "id")
    assert rows_of(read_keyed(spark, path)) == expected
    assert watermark(read_keyed(spark, path), "created_at", "1900-01-01") == T2


def test_watermark_default(spark, folder):
    upsert(frame(spark, [(1, "a", None)]), f"{folder}/t", "id")
    assert watermark(read_keyed(spark, f"{folder}/t"), "created_at", "1900-01-01") == datetime(1900, 1, 1)


def folders_read(df):
    return {Path(f).parent.name for f in df.inputFiles()}


def test_only_touched_ranges_are_written_and_read(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(i, "a", T1) for i in (5, 15, 25)]), path, "id", keys_per_range=10)
    before = read_manifest(spark, path)[1]
    upsert(frame(spark, [(17, "n", T2), (15, "A", T2)]), path, "id", keys_per_range=10)
    after = read_manifest(spark, path)[1]
    assert {r for r in after if after[r] == before.get(r)} == {0, 2} and set(after) == {0, 1, 2}
    assert rows_of(read_keyed(spark, path)) == rows_of(
        frame(spark, [(5, "a", T1), (15, "A", T2), (17, "n", T2), (25, "a", T1)])
    )
    ranges = spark.createDataFrame([(1,), (None,), (77,), (1,)], "r bigint")
    assert folders_read(read_keyed(spark, path, ranges)) == {f"{RANGE}=1"}
    assert read_keyed(spark, path, ranges.filter("r = 77")) is None


def test_many_ranges_are_pruned_without_a_limit(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(400).select("id", F.lit("a").alias("v"), F.lit(T1).cast("timestamp_ntz").alias("created_at"))
    upsert(rows, path, "id", keys_per_range=1)
    upsert(rows.filter("id % 2 = 0").withColumn("v", F.lit("b")), path, "id", keys_per_range=1)
    even = read_keyed(spark, path, spark.range(0, 10**6, 2))
    assert len(folders_read(even)) == 200 and {r["v"] for r in even.collect()} == {"b"}
    assert read_keyed(spark, path).filter("v = 'a'").count() == 200


class Cut(RuntimeError):
    pass


def fail(*_):
    raise Cut


@pytest.mark.parametrize("step", ["_write", "publish"])
def test_a_first_load_cut_short_is_not_seen(spark, folder, monkeypatch, step):
    path, rows = f"{folder}/t", frame(spark, [(1, "a", T1), (25, "b", T1)])
    with monkeypatch.context() as patch:
        patch.setattr(module, step, fail)
        with pytest.raises(Cut):
            upsert(rows, path, "id", keys_per_range=10)
    assert read_keyed(spark, path) is None
    upsert(rows, path, "id", keys_per_range=10)
    assert read_keyed(spark, path).count() == 2


def test_a_later_run_cut_short_leaves_the_table(spark, folder, monkeypatch):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (2, "b", T1), (25, "c", T1)]), path, "id", keys_per_range=10)
    batch = frame(spark, [(2, "B", T2), (26, "d", T2)])

    def half(rows, target):
        """One of the ranges arrives, then the driver is gone."""
        write(rows.filter(F.col(RANGE) == 0), target)
        raise Cut

    write = module._write
    for step, failing in (("_write", half), ("publish", fail)):
        with monkeypatch.context() as patch:
            patch.setattr(module, step, failing)
            with pytest.raises(Cut):
                upsert(batch, path, "id", keys_per_range=10)
        assert {(r["id"], r["v"]) for r in read_keyed(spark, path).collect()} == {(1, "a"), (2, "b"), (25, "c")}
    upsert(batch, path, "id", keys_per_range=10, grace=timedelta(0))
    assert {(r["id"], r["v"]) for r in read_keyed(spark, path).collect()} == {(1, "a"), (2, "B"), (25, "c"), (26, "d")}
    # What the broken runs left is gone; the version before stays for its readers.
    assert len(list(Path(path, "data").iterdir())) == 2


def test_null_keys_never_match(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(None, "a", T1), (1, "x", T1)]), path, "id")
    upsert(frame(spark, [(None, "b", T2), (1, "y", T2)]), path, "id")
    assert rows_of(read_keyed(spark, path)) == rows_of(
        frame(spark, [(None, "a", T1), (None, "b", T2), (1, "y", T2)])
    )


def test_schema_sync(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (2, "b", T1)]), path, "id", keys_per_range=1)
    upsert(
        frame(spark, [(2, T2, 9)], "id bigint, created_at timestamp_ntz, extra int"),
        path, "id", keys_per_range=1,
    )
    stored = read_keyed(spark, path)
    assert stored.columns == ["id", "created_at", "extra"]
    assert rows_of(stored) == rows_of(
        frame(spark, [(1, T1, None), (2, T2, 9)], "id bigint, created_at timestamp_ntz, extra int")
    )


def test_repeated_keys_fail_before_the_write(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1)]), path, "id")
    with pytest.raises(DuplicateKeys):
        upsert(frame(spark, [(1, "b", T2), (1, "c", T2)]), path, "id")
    assert rows_of(read_keyed(spark, path)) == [(1, "a", T1)]


def test_large_batch_against_brute_force(spark, folder):
    path = f"{folder}/t"
    first = spark.range(5_000).select("id", F.lit("old").alias("v"), F.lit(T1).cast("timestamp_ntz").alias("created_at"))
    second = spark.range(4_000, 9_000, 3).select("id", F.lit("new").alias("v"), F.lit(T2).cast("timestamp_ntz").alias("created_at"))
    upsert(first, path, "id", keys_per_range=500)
    upsert(second, path, "id", keys_per_range=500)
    table = {i: "old" for i in range(5_000)} | {i: "new" for i in range(4_000, 9_000, 3)}
    assert {r["id"]: r["v"] for r in read_keyed(spark, path).collect()} == table


def test_one_crowded_range_is_split_over_tasks(spark, folder):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        rows = spark.range(0, 60_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v"))
        upsert(rows, f"{folder}/t", "id", known_unique=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list(Path(f"{folder}/t/data").glob(f"*/{RANGE}=0/*.parquet"))) > 4
    assert read_keyed(spark, f"{folder}/t").count() == 60_000


def interleaved(module_, monkeypatch, other):
    """While the next upsert has written its ranges, and not yet its manifest, another writer commits."""
    write = module_._write
    waiting = [other]

    def then(rows, target):
        write(rows, target)
        if waiting:
            waiting.pop()()

    monkeypatch.setattr(module_, "_write", then)


@pytest.mark.parametrize("grace", [timedelta(0), timedelta(days=1)])
def test_two_writers_on_different_ranges(spark, folder, monkeypatch, grace):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (15, "b", T1), (25, "c", T1)]), path, "id", keys_per_range=10)
    second = frame(spark, [(16, "N", T2), (15, "B", T2)])
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(second, path, "id", keys_per_range=10))
        upsert(frame(spark, [(2, "n", T2), (99, "z", T2)]), path, "id", keys_per_range=10, grace=grace)
    expected = [(1, "a", T1), (2, "n", T2), (15, "B", T2), (16, "N", T2), (25, "c", T1), (99, "z", T2)]
    assert rows_of(read_keyed(spark, path)) == rows_of(frame(spark, expected))
    assert read_manifest(spark, path)[0] == 3


def test_two_writers_on_equal_ranges(spark, folder, monkeypatch):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (2, "b", T1)]), path, "id")
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(frame(spark, [(2, "first", T2), (3, "c", T2)]), path, "id"))
        upsert(frame(spark, [(1, "second", T2), (4, "d", T2)]), path, "id")
    expected = [(1, "second", T2), (2, "first", T2), (3, "c", T2), (4, "d", T2)]
    assert rows_of(read_keyed(spark, path)) == rows_of(frame(spark, expected))


def test_two_first_loads(spark, folder, monkeypatch):
    path = f"{folder}/t"
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(frame(spark, [(2, "first", T1)]), path, "id"))
        upsert(frame(spark, [(1, "second", T1)]), path, "id", known_unique=True)
    assert rows_of(read_keyed(spark, path)) == rows_of(frame(spark, [(1, "second", T1), (2, "first", T1)]))


def test_a_writer_that_adds_a_column_meanwhile(spark, folder, monkeypatch):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (15, "b", T1)]), path, "id", keys_per_range=10)
    wider = frame(spark, [(15, "B", T2, 7)], f"{DDL}, extra int")
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(wider, path, "id", keys_per_range=10))
        upsert(frame(spark, [(1, "A", T2, 8)], f"{DDL}, extra int"), path, "id", keys_per_range=10)
    expected = frame(spark, [(1, "A", T2, 8), (15, "B", T2, 7)], f"{DDL}, extra int")
    assert rows_of(read_keyed(spark, path)) == rows_of(expected)


def test_reading_a_manifest_runs_no_job(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1)]), path, "id")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("manifest", "reading")
    assert read_manifest(spark, path)[0] == 1
    assert len(tracker.getJobIdsForGroup("manifest")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_taken_number_is_not_overwritten(spark, folder):
    assert module.publish(spark, f"{folder}/t", 1, {0: "va"})
    assert not module.publish(spark, f"{folder}/t", 1, {0: "vb"})
    assert read_manifest(spark, f"{folder}/t") == (1, {0: "va"})


def written_rows(spark, path, before):
    """Rows in the files that came after ``before``."""
    new = [str(f) for f in Path(path, "data").rglob("*.parquet") if f not in before]
    return spark.read.parquet(*new).count()


def test_a_delta_writes_only_its_batch(spark, folder):
    path = f"{folder}/t"
    rows = spark.range(2_000).select("id", F.lit("old").alias("v"), F.lit(T1).cast("timestamp_ntz").alias("created_at"))
    upsert(rows, path, "id", keys_per_range=100)
    table = {i: "old" for i in range(2_000)}
    for number, step in enumerate((97, 89, 83)):
        before = set(Path(path, "data").rglob("*.parquet"))
        batch = spark.range(number, 2_100, step).select("id", F.lit(f"d{number}").alias("v"), F.lit(T2).cast("timestamp_ntz").alias("created_at"))
        upsert(batch, path, "id", keys_per_range=100, deltas=True)
        table |= {i: f"d{number}" for i in range(number, 2_100, step)}
        assert before <= set(Path(path, "data").rglob("*.parquet"))
        assert written_rows(spark, path, before) == batch.count()
        stored = read_keyed(spark, path)
        assert stored.columns == ["id", "v", "created_at"]
        assert sorted((r["id"], r["v"]) for r in stored.collect()) == sorted(table.items())
    assert module.compact(spark, path, most_deltas=3) == 0
    # A rewrite merges the layers of what it touches, and a compaction those of the rest.
    upsert(frame(spark, [(150, "w", T2)]), path, "id", keys_per_range=100)
    table[150] = "w"
    assert isinstance(read_manifest(spark, path)[1][1], str)
    assert module.compact(spark, path, grace=timedelta(0)) > 10
    assert all(isinstance(e, str) for e in read_manifest(spark, path)[1].values())
    assert sorted((r["id"], r["v"]) for r in read_keyed(spark, path).collect()) == sorted(table.items())
    assert module.compact(spark, path) == 0


def test_deltas_of_null_keys_add_up(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(None, "a", T1), (1, "x", T1)]), path, "id")
    upsert(frame(spark, [(None, "b", T2), (1, "y", T2)]), path, "id", deltas=True)
    expected = rows_of(frame(spark, [(None, "a", T1), (None, "b", T2), (1, "y", T2)]))
    assert rows_of(read_keyed(spark, path)) == expected
    module.compact(spark, path)
    assert rows_of(read_keyed(spark, path)) == expected


def test_a_delta_with_other_columns_rewrites(spark, folder):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (15, "b", T1)]), path, "id", keys_per_range=10)
    upsert(frame(spark, [(1, "A", T2)]), path, "id", keys_per_range=10, deltas=True)
    upsert(frame(spark, [(15, "B", T2, 7)], f"{DDL}, extra int"), path, "id", keys_per_range=10, deltas=True)
    expected = frame(spark, [(1, "A", T2, None), (15, "B", T2, 7)], f"{DDL}, extra int")
    assert rows_of(read_keyed(spark, path)) == rows_of(expected)
    assert all(isinstance(e, str) for e in read_manifest(spark, path)[1].values())


def test_two_writers_of_deltas(spark, folder, monkeypatch):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (2, "b", T1)]), path, "id")
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(frame(spark, [(2, "under", T2), (3, "c", T2)]), path, "id", deltas=True))
        upsert(frame(spark, [(2, "top", T2), (4, "d", T2)]), path, "id", deltas=True)
    expected = rows_of(frame(spark, [(1, "a", T1), (2, "top", T2), (3, "c", T2), (4, "d", T2)]))
    assert rows_of(read_keyed(spark, path)) == expected
    # A delta that comes while the table is compacted stays on top of the new files.
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(frame(spark, [(1, "late", T2)]), path, "id", deltas=True))
        assert module.compact(spark, path) == 1
    assert len(read_manifest(spark, path)[1][0].deltas) == 1
    expected = rows_of(frame(spark, [(1, "late", T2), (2, "top", T2), (3, "c", T2), (4, "d", T2)]))
    assert rows_of(read_keyed(spark, path)) == expected


def test_a_compaction_starts_again_after_a_rewrite(spark, folder, monkeypatch):
    path = f"{folder}/t"
    upsert(frame(spark, [(1, "a", T1), (2, "b", T1)]), path, "id")
    upsert(frame(spark, [(2, "B", T2)]), path, "id", deltas=True)
    with monkeypatch.context() as patch:
        interleaved(module, patch, lambda: upsert(frame(spark, [(1, "A", T2)]), path, "id"))
        assert module.compact(spark, path) == 0
    assert rows_of(read_keyed(spark, path)) == rows_of(frame(spark, [(1, "A", T2), (2, "B", T2)]))


def test_deltas_do_not_look_at_stored_rows(spark, folder):
    with pytest.raises(ValueError, match="without looking"):
        upsert(frame(spark, [(1, "a", T1)]), f"{folder}/t", "id", match_null=True, deltas=True)
