"""Keyed incremental upsert into a parquet table.

The table is partitioned by ranges of its integer key. A batch rewrites only the ranges it
touches, into a folder of its own version; a manifest then names the folder of every range
and is the last, single file written. Readers follow the newest manifest, so a run that was
cut short anywhere leaves the table as it was, and its half-written folders are never read.

Several writers may work on one table. A manifest is created only if there is none of its
number; who comes second looks at what the first has changed. Where no range is touched by
both, the second writer's ranges are added to the newer manifest; otherwise its batch is merged
again. Folders that neither the newest nor the previous manifest names are deleted once they are
older than a grace period, which has to be longer than any run.

Serial keys grow with time, so a daily batch lands in few ranges. A change of columns
rewrites every range. Running the same batch again gives the same table.

A batch scattered over all ranges would rewrite the whole table. It can be written as a delta
instead: one more layer of just its own rows over the files of each range it touches. Readers
take a key's row from its newest layer. ``compact`` merges the layers of a range into new files.
Deltas of two writers never conflict; the later one lies on top.

Every range costs a file in each write and a folder in each listing. A table that is given a most
number of ranges doubles their width instead of passing it, up to the common width, and is rewritten
then, as for a change of columns. The versions of such a table name its width, so the manifest says it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wanderlake.functions.text import keys_packed, keys_unpacked, surrogate_columns
from wanderlake.operators.latest import latest_per_key
from wanderlake.session import children, create_file, listing, read_bytes, remove, scratch_dir

RANGE = "key_range"
VERSION = "version"
NUMBER = "manifest"
GRACE = timedelta(days=1)
MOST_TRIES = 50
KEYS_PER_RANGE = 1_000_000
MOST_RANGES = 128  # of a table with narrower ranges
DELTAS = "deltas"
KEY = "key"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ORDER = "__order"
_NEW = "__new"
_RANK = "__rank"


class Layers(NamedTuple):
    """A range with deltas: its base version, and number and version of each delta, oldest first."""

    base: str
    deltas: tuple[tuple[int, str], ...]
    key: str


# The version of each range, or its layers.
Manifest = dict[int | None, str | Layers]


class DuplicateKeys(ValueError):
    """An update batch holds a key more than once."""


class TooManyConflicts(RuntimeError):
    """Other writers changed the same ranges again and again."""


def read_manifest(spark: SparkSession, path: str) -> tuple[int, Manifest]:
    """Number of the newest manifest and the version of each range; 0 before the first load.

    It has one entry for each range of the table, whatever the number of rows. The newest one
    is known from its name, so one small file is read and no job runs.
    """
    number = max((int(n.split("=")[1]) for n in children(spark, f"{path}/manifests") if n.startswith(f"{NUMBER}=")), default=0)
    if not number:
        return 0, {}
    entries = json.loads(read_bytes(spark, f"{path}/manifests/{NUMBER}={number}"))
    return number, {entry[RANGE]: _entry(entry) for entry in entries}


def _entry(row: dict) -> str | Layers:
    if DELTAS not in row:
        return row[VERSION]
    return Layers(row[VERSION], tuple((n, v) for n, v in row[DELTAS]), row[KEY])


def _row(key_range: int | None, entry: str | Layers) -> dict:
    if isinstance(entry, str):
        return {RANGE: key_range, VERSION: entry}
    return {RANGE: key_range, VERSION: entry.base, DELTAS: entry.deltas, KEY: entry.key}


def versions_of(entry: str | Layers) -> list[str]:
    """All versions that make up a range, oldest first."""
    return [entry] if isinstance(entry, str) else [entry.base, *(v for _, v in entry.deltas)]


def width_of(entries: Manifest) -> int | None:
    """Keys in a range of a table whose ranges were widened; None if they are as its writers say."""
    widths = [int(v[1:].split("-")[0]) for e in entries.values() for v in versions_of(e) if "-" in v]
    return max(widths, default=None)


def state_of(key_range: int | None, entry: str | Layers) -> str:
    """Name of a range with exactly these layers of files."""
    return ":".join([str(key_range), *versions_of(entry)])


def read_keyed(spark: SparkSession, path: str, ranges: DataFrame | None = None) -> DataFrame | None:
    """The table at ``path`` without its layout columns, or None before its first rows.

    With ``ranges`` (one column of range numbers) only their folders are listed and read, and
    None says that the table has none of them. They are matched with the manifest in Spark, so
    no more than its entries come to the driver, however many numbers a batch names.
    """
    _, entries = read_manifest(spark, path)
    if ranges is not None and entries:
        known = spark.createDataFrame([(r,) for r in entries], f"{RANGE} bigint")
        wanted = ranges.toDF("__wanted").distinct()
        found = known.join(wanted, F.col(RANGE).eqNullSafe(F.col("__wanted")), "left_semi").collect()
        entries = {r[RANGE]: entries[r[RANGE]] for r in found}
    return _read(spark, path, entries)


def read_ranges(spark: SparkSession, path: str, entries: Manifest) -> DataFrame | None:
    """The rows of some ranges of a manifest, with their range; None if there are none.

    Ranges without deltas are plain scans. In the others, base rows whose key a delta holds are
    left out by an anti join, which Spark broadcasts as long as the deltas' files are small, and
    a key in several deltas is taken from the newest. Rows with a NULL key never replace each
    other, so their layers are simply added up.
    """
    if not entries:
        return None
    layered = {r: e for r, e in entries.items() if isinstance(e, Layers) and r is not None}
    plain = [(r, v) for r, e in entries.items() if r not in layered for v in versions_of(e)]
    parts = [_scan(spark, path, plain).drop(VERSION)] if plain else []
    if layered:
        key = next(iter(layered.values())).key
        numbers = {v: n for e in layered.values() for n, v in e.deltas}
        deltas = _scan(spark, path, [(r, v) for r, e in layered.items() for _, v in e.deltas])
        base = _scan(spark, path, [(r, e.base) for r, e in layered.items()]).drop(VERSION)
        parts.append(base.join(deltas.select(key), key, "left_anti").select(*base.columns))
        if any(len(e.deltas) > 1 for e in layered.values()):
            order = spark.createDataFrame(list(numbers.items()), f"{VERSION} string, {_ORDER} bigint")
            deltas = latest_per_key(deltas.join(F.broadcast(order), VERSION), [key], [_ORDER]).drop(_ORDER)
        parts.append(deltas.drop(VERSION))
    return reduce(lambda one, other: one.unionByName(other), parts)


def _read(spark: SparkSession, path: str, entries: Manifest) -> DataFrame | None:
    rows = read_ranges(spark, path, entries)
    return None if rows is None else rows.drop(RANGE)


def _scan(spark: SparkSession, path: str, places: Iterable[tuple[int | None, str]]) -> DataFrame:
    data = f"{path}/data"
    folders = [f"{data}/{VERSION}={v}/{RANGE}={_NULL_FOLDER if r is None else r}" for r, v in places]
    rows = spark.read.option("basePath", data).parquet(*folders)
    return rows.withColumn(RANGE, F.col(RANGE).cast("bigint"))


def watermark(target: DataFrame, column: str, default: str) -> datetime:
    """Largest value of ``column`` in the target, or the default, as one driver-side value."""
    floor = F.lit(default).cast("timestamp_ntz")
    return target.agg(F.coalesce(F.max(column), floor).alias("mark")).first()["mark"]


def merged(target: DataFrame, updates: DataFrame, key: str, match_null: bool = False) -> DataFrame:
    """Target rows whose key is not updated, plus all updates, in the updates' columns.

    Both have their key range. Every row is moved once, to the task of its range, where the rows
    of a key meet; the result lies by range. Columns new in the updates are NULL in kept rows;
    columns the updates no longer have disappear. Rows with a NULL key never match: they stay out
    of the ranking, which would gather them in one task, and are kept as they are. With
    ``match_null``, for tables with at most one such row, NULL is a key like any other.
    """
    both = _together(target.withColumn(_NEW, F.lit(0)), updates.withColumn(_NEW, F.lit(1)))
    keyed = both if match_null else both.filter(F.col(key).isNotNull())
    # RANGE follows from the key; with it the ranking takes rows that lie by range as they are.
    newest = Window.partitionBy(RANGE, key).orderBy(F.desc(_NEW))
    ranked = _moved(keyed, lambda rows: rows.repartition(RANGE)).withColumn(_RANK, F.rank().over(newest))
    rows = ranked.filter(F.col(_RANK) == 1).drop(_NEW, _RANK)
    if not match_null:
        rows = rows.unionByName(_gathered(both.filter(F.col(key).isNull()).drop(_NEW)))
    return rows


def chosen(target: DataFrame, updates: DataFrame, key: str, match_null: bool, choose: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``choose`` leaves of the target's and the new rows, in the updates' columns; moved once, as ``merged`` does.

    NULL keys of the target never match without ``match_null`` and are kept.
    """
    keyed = target if match_null else target.filter(F.col(key).isNotNull())
    both = _together(keyed, updates)
    rows = choose(_moved(both, lambda rows: rows.repartition(RANGE))).select(*updates.columns)
    if not match_null:
        left = target.filter(F.col(key).isNull()).unionByName(updates.limit(0), allowMissingColumns=True)
        rows = rows.unionByName(_gathered(left.select(*updates.columns)))
    return rows


def _together(target: DataFrame, updates: DataFrame) -> DataFrame:
    return target.unionByName(updates, allowMissingColumns=True).select(*updates.columns)


def _moved(rows: DataFrame, move: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows after a shuffle that carries surrogate keys as bytes."""
    keys = surrogate_columns(rows)
    return keys_unpacked(move(keys_packed(rows, keys)), keys) if keys else move(rows)


def _gathered(rows: DataFrame) -> DataFrame:
    """The rows by range: rebalancing gathers a range in few files, joins small ranges in one task, and
    splits whatever is larger than the advisory size, such as many rows without a key."""
    return _moved(rows, lambda moving: moving.hint("rebalance", RANGE))


def upsert(
    updates: DataFrame,
    path: str,
    key: str,
    keys_per_range: int = KEYS_PER_RANGE,
    known_unique: bool = False,
    match_null: bool = False,
    grace: timedelta = GRACE,
    choose: Callable[[DataFrame], DataFrame] | None = None,
    deltas: bool = False,
    most_ranges: int | None = None,
    keys: DataFrame | None = None,
) -> None:
    """Replace rows with a matching key and insert the others.

    ``known_unique`` skips the duplicate check for batches already reduced to one row per
    key; without it a repeated key fails before anything is written. The batch is computed
    once: into the shared scratch folder, from which the merge reads it and which is deleted after
    the commit, or, as deltas that need no check, straight into its layer.

    ``choose`` decides between stored and new rows: it gets the rows of the ranges that the batch
    touches, by ``RANGE`` in their tasks, and returns one row for each key. A key that has only one
    row there keeps it. Without ``choose`` the new row wins.

    ``deltas`` writes the batch alone, as a layer over the ranges it touches, whose files stay as
    they are. It cannot be combined with ``choose`` or ``match_null``, which look at stored rows.
    A batch with other columns than the table still rewrites every range.

    ``most_ranges`` widens ranges of less than ``KEYS_PER_RANGE`` keys as far as the table would get
    more of them. ``keys`` has at least the keys of the batch and is cheaper to read than a first one.
    """
    if deltas and (choose or match_null):
        raise ValueError("deltas are written without looking at stored rows")
    spark = updates.sparkSession
    number, entries = read_manifest(spark, path)
    ranged = updates.withColumn(RANGE, range_of(F.col(key), keys_per_range))
    staging = None
    if not known_unique:
        ranged, staging = _staged(ranged)
        _require_unique(ranged, key)
    for _ in range(MOST_TRIES):
        width = width_of(entries) or keys_per_range
        if deltas and entries and _same_columns(_read(spark, path, entries), ranged.drop(RANGE)):
            change = _append(_placed(ranged, key, width), path, key, entries)
        else:
            if entries and not staging:
                ranged, staging = _staged(ranged)
            wide = _widened(entries, ranged if entries or keys is None else keys, key, width, most_ranges) if most_ranges else width
            change = _rewrite(_placed(ranged, key, wide), path, key, wide, entries, match_null, choose, wide != width)
        done, number, entries, named = _commit(spark, path, number, entries, change)
        if done:
            break
    else:
        raise TooManyConflicts(path)
    _forget(spark, path, number, named, grace)
    if staging:
        remove(spark, staging)


def _placed(rows: DataFrame, key: str, width: int) -> DataFrame:
    return rows.withColumn(RANGE, range_of(F.col(key), width))


def _widened(entries: Manifest, batch: DataFrame, key: str, width: int, most: int) -> int:
    """The width, doubled until table and batch have at most ``most`` ranges or the common width is reached."""
    times = [1]
    while width * times[-1] < KEYS_PER_RANGE:
        times.append(2 * times[-1])
    if len(times) == 1:
        return width
    stored = batch.sparkSession.createDataFrame([(r,) for r in entries if r is not None], f"{RANGE} bigint")
    numbers = batch.select(range_of(F.col(key), width).alias(RANGE)).distinct().unionByName(stored)
    counted = numbers.agg(*[F.count_distinct(F.floor(F.col(RANGE) / n)).alias(str(n)) for n in times]).first()
    return width * next((n for n in times if counted[str(n)] <= most), times[-1])


def _staged(ranged: DataFrame) -> tuple[DataFrame, str]:
    """The batch as stored in the shared scratch folder, and its folder there."""
    staging = scratch_dir(ranged.sparkSession, "upsert")
    ranged.write.parquet(staging)
    return ranged.sparkSession.read.schema(ranged.schema).parquet(staging), staging


def compact(spark: SparkSession, path: str, most_deltas: int = 0, grace: timedelta = GRACE) -> int:
    """Merge the layers of every range that has more than ``most_deltas`` deltas; returns how many.

    Other ranges are neither read nor written. Deltas that another writer adds meanwhile stay on
    top of the new files; only a rewrite of the same ranges makes it start again.
    """
    number, entries = read_manifest(spark, path)
    for _ in range(MOST_TRIES):
        crowded = {r: e for r, e in entries.items() if isinstance(e, Layers) and len(e.deltas) > most_deltas}
        if not crowded:
            return 0
        version = _new_version(width_of(entries))
        _write(_gathered(read_ranges(spark, path, crowded)), f"{path}/data/{VERSION}={version}")
        change = _replace_layers(crowded, version)
        done, number, entries, named = _commit(spark, path, number, entries, change)
        if done:
            _forget(spark, path, number, named, grace)
            return len(crowded)
    raise TooManyConflicts(path)


# What a writer makes of the newest manifest, given the number of the next one; None if it
# conflicts with what happened since the writer read the table.
Change = Callable[[int, Manifest], Manifest | None]


def _append(ranged: DataFrame, path: str, key: str, entries: Manifest) -> Change:
    """Write a batch as a delta, whatever ranges it touches."""
    spark, version = ranged.sparkSession, _new_version(width_of(entries))
    _write(_gathered(ranged), f"{path}/data/{VERSION}={version}")
    touched = _ranges_in(spark, path, version)

    def change(number: int, newest: Manifest) -> Manifest | None:
        if width_of(newest) != width_of(entries):
            return None
        if newest != entries and not _same_columns(_read(spark, path, newest), ranged.drop(RANGE)):
            return None
        after = dict(newest)
        for r in touched:
            old = newest.get(r)
            if old is None:
                after[r] = version
            else:
                base, before = (old.base, old.deltas) if isinstance(old, Layers) else (old, ())
                after[r] = Layers(base, (*before, (number, version)), key)
        return after

    return change


def _replace_layers(crowded: Manifest, version: str) -> Change:
    def change(number: int, newest: Manifest) -> Manifest | None:
        after = dict(newest)
        for r, old in crowded.items():
            now = newest.get(r)
            if not isinstance(now, Layers) or now.base != old.base or now.deltas[: len(old.deltas)] != old.deltas:
                return None
            rest = now.deltas[len(old.deltas) :]
            after[r] = Layers(version, rest, now.key) if rest else version
        return after

    return change


def _rewrite(
    ranged: DataFrame, path: str, key: str, keys_per_range: int, entries: Manifest, match_null: bool, choose, widened: bool
) -> Change:
    """Write the ranges of a batch anew, all of them if they were ``widened``."""
    spark, rows, affected = ranged.sparkSession, None, {}
    if entries:
        affected = entries
        if not widened and _same_columns(_read(spark, path, entries), ranged.drop(RANGE)):
            # Ranges of the batch are no more than the table has afterwards.
            touched = {r[RANGE] for r in ranged.select(RANGE).distinct().collect()}
            affected = {r: v for r, v in entries.items() if r in touched}
        stored = _read(spark, path, affected)
        if stored is not None:
            target = stored.withColumn(RANGE, range_of(F.col(key), keys_per_range))
            rows = chosen(target, ranged, key, match_null, choose) if choose else merged(target, ranged, key, match_null)
    version = _new_version(keys_per_range if widened else width_of(entries))
    _write(_gathered(ranged) if rows is None else rows, f"{path}/data/{VERSION}={version}")
    new = dict.fromkeys(_ranges_in(spark, path, version), version)

    def change(number: int, newest: Manifest) -> Manifest | None:
        # A change of columns rewrites all ranges, so it is found here, too.
        if width_of(newest) != width_of(entries) or any(entries.get(r) != newest.get(r) for r in affected.keys() | new.keys()):
            return None
        return {**{r: v for r, v in newest.items() if r not in affected}, **new}

    return change


def _new_version(width: int | None = None) -> str:
    return f"v{uuid.uuid4().hex}" if width is None else f"v{width}-{uuid.uuid4().hex}"


def _ranges_in(spark: SparkSession, path: str, version: str) -> list[int | None]:
    names = children(spark, f"{path}/data/{VERSION}={version}")
    values = [n.split("=")[1] for n in names if n.startswith(f"{RANGE}=")]
    return [None if v == _NULL_FOLDER else int(v) for v in values]


def _commit(spark: SparkSession, path: str, number: int, entries: Manifest, change: Change) -> tuple[bool, int, Manifest, set[str]]:
    """Publish a change of the newest manifest; False if another writer's change conflicts with it.

    Also returns the newest manifest and the versions that readers may still follow.
    """
    for _ in range(MOST_TRIES):
        after = change(number + 1, entries)
        if after is None:
            return False, number, entries, set()
        if publish(spark, path, number + 1, after):
            named = {v for known in (entries, after) for e in known.values() for v in versions_of(e)}
            return True, number, after, named
        number, entries = read_manifest(spark, path)
    raise TooManyConflicts(path)


def publish(spark: SparkSession, path: str, number: int, entries: Manifest) -> bool:
    """Write a manifest: one file, which appears whole or not at all; False if the number is taken."""
    rows = [_row(r, e) for r, e in entries.items()]
    return create_file(spark, f"{path}/manifests/{NUMBER}={number}", json.dumps(rows).encode())


def _forget(spark: SparkSession, path: str, previous: int, versions: Iterable[str], grace: timedelta) -> None:
    """Delete what neither the newest manifest nor the one before it names, past the grace period."""
    until = time.time() - grace.total_seconds()
    named = {f"{VERSION}={v}" for v in versions}
    number, newest = read_manifest(spark, path)
    named |= {f"{VERSION}={v}" for e in newest.values() for v in versions_of(e)}
    for name, changed in listing(spark, f"{path}/data"):
        if name.startswith(f"{VERSION}=") and name not in named and changed <= until:
            remove(spark, f"{path}/data/{name}")
    for name, changed in listing(spark, f"{path}/manifests"):
        if name.startswith(f"{NUMBER}=") and int(name.split("=")[1]) < min(previous, number) and changed <= until:
            remove(spark, f"{path}/manifests/{name}")


def range_of(key: Column, keys_per_range: int = KEYS_PER_RANGE) -> Column:
    return F.floor(key / keys_per_range).cast("bigint")


def _same_columns(stored: DataFrame, updates: DataFrame) -> bool:
    def shape(df: DataFrame) -> dict:
        return {f.name: f.dataType for f in df.schema.fields}

    return shape(stored) == shape(updates)


def _write(rows: DataFrame, path: str) -> None:
    """Write rows that lie by range."""
    rows.write.partitionBy(RANGE).parquet(path)


def _require_unique(updates: DataFrame, key: str) -> None:
    repeated = (
        updates.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1)
    )
    if not repeated.isEmpty():
        raise DuplicateKeys(f"update batch repeats a value of {key}")
