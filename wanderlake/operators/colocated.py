"""Link tables bucketed by their key, which lookups join without moving them.

A link table holds a few columns for each key. Every load is one folder of files bucketed and
sorted by the key, with one file a bucket; a manifest, created only if its number is free, names
the loads, oldest first, and says what they cover. A key's row is the one of the newest load that
has it. All loads have the same buckets, so neither finding that row nor a join on the key shuffles
them: only the other side of a join moves.

Spark knows the buckets of tables in its catalog only. Reading registers the loads of a manifest
as an external table of the session's catalog under a name made of path and manifest number;
files are never owned by the catalog. Rows without a key are left out, as they match nothing.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.operators.latest import latest_per_key
from wanderlake.operators.upsert import GRACE, MOST_TRIES, TooManyConflicts
from wanderlake.session import children, create_file, listing, read_bytes, remove

LOAD = "load"
MOST_LOADS = 8
_ORDER = "__order"


class Links(NamedTuple):
    """What a manifest says: key, columns as DDL, number of buckets, loads and what they cover."""

    key: str
    columns: str
    buckets: int
    loads: tuple[str, ...]
    covers: frozenset[str]


class OtherLayout(ValueError):
    """Rows have other columns, another key or other buckets than the table."""


def read_links(spark: SparkSession, path: str) -> tuple[int, Links | None]:
    """Number of the newest manifest and what it says; 0 and None before the first load."""
    number = max((int(n.split("=")[1]) for n in children(spark, f"{path}/manifests") if n.startswith("manifest=")), default=0)
    if not number:
        return 0, None
    said = json.loads(read_bytes(spark, f"{path}/manifests/manifest={number}"))
    return number, Links(said["key"], said["columns"], said["buckets"], tuple(said["loads"]), frozenset(said["covers"]))


def append(rows: DataFrame, path: str, key: str, buckets: int, covers: Iterable[str] = ()) -> None:
    """Add rows, of which each key has at most one, as the newest load.

    ``covers`` names everything that the table covers with these rows. The number of buckets is
    fixed by the first load; choose it so that a bucket of all keys fits a task.
    """
    spark, covered = rows.sparkSession, frozenset(covers)
    load, columns = _write(rows, path, key, buckets), _ddl(rows)

    def change(now: Links | None) -> Links:
        if now and (now.key, now.columns, now.buckets) != (key, columns, buckets):
            raise OtherLayout(f"{path} has {now.columns} in {now.buckets} buckets by {now.key}")
        return Links(key, columns, buckets, (*(now.loads if now else ()), load), covered)

    _commit(spark, path, change)


def compact(spark: SparkSession, path: str, most_loads: int = MOST_LOADS, grace: timedelta = GRACE) -> bool:
    """Merge all loads into one if there are more than ``most_loads``; loads that come meanwhile stay on top.

    Loads that no manifest of the last two names are deleted once they are older than ``grace``.
    """
    _, links = read_links(spark, path)
    if links is None or len(links.loads) <= most_loads:
        return False
    merged = _write(read(spark, path), path, links.key, links.buckets)

    def change(now: Links) -> Links | None:
        if now.loads[: len(links.loads)] != links.loads:
            return None
        return now._replace(loads=(merged, *now.loads[len(links.loads) :]))

    done = _commit(spark, path, change)
    _forget(spark, path, grace)
    return done


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest row of every key, bucketed by the key; None before the first load."""
    number, links = read_links(spark, path)
    if links is None:
        return None
    rows = spark.table(_registered(spark, path, number, links))
    if len(links.loads) > 1:
        names = F.array(*[F.lit(load) for load in links.loads])
        newest = latest_per_key(rows.withColumn(_ORDER, F.array_position(names, F.col(LOAD))), [links.key], [_ORDER])
        rows = newest.drop(_ORDER)
    return rows.drop(LOAD)


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> str:
    spark, load = rows.sparkSession, uuid.uuid4().hex
    name = f"wanderlake_write_{load}"
    # The repartitioning hashes as the buckets do, so every bucket is one file of one task.
    placed = rows.filter(F.col(key).isNotNull()).repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/loads/{LOAD}={load}").saveAsTable(name, format="parquet")
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return load


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def _registered(spark: SparkSession, path: str, number: int, links: Links) -> str:
    """Name of the catalog's table of these loads; those of manifests long past are dropped."""
    prefix = f"wanderlake_links_{hashlib.sha256(path.encode()).hexdigest()[:16]}_"
    name = f"{prefix}{number}"
    if not spark.catalog.tableExists(name):
        waiting = f"{prefix}new_{uuid.uuid4().hex}"
        location = f"{path}/loads".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {waiting} ({links.columns}, {LOAD} string) USING parquet PARTITIONED BY ({LOAD}) "
            f"CLUSTERED BY (`{links.key}`) SORTED BY (`{links.key}`) INTO {links.buckets} BUCKETS LOCATION '{location}'"
        )
        loads = " ".join(f"PARTITION ({LOAD} = '{load}')" for load in links.loads)
        spark.sql(f"ALTER TABLE {waiting} ADD {loads}")
        spark.sql(f"ALTER TABLE {waiting} RENAME TO {name}")
    for row in spark.sql(f"SHOW TABLES LIKE '{prefix}*'").collect():
        last = row["tableName"].removeprefix(prefix)
        if last.isdigit() and int(last) < number - 1:
            spark.sql(f"DROP TABLE {row['tableName']}")
    return name


def _commit(spark: SparkSession, path: str, change) -> bool:
    """Publish a change of the newest manifest; False if it no longer applies."""
    for _ in range(MOST_TRIES):
        number, now = read_links(spark, path)
        after = change(now)
        if after is None:
            return False
        content = json.dumps({**after._asdict(), "covers": sorted(after.covers)}).encode()
        if create_file(spark, f"{path}/manifests/manifest={number + 1}", content):
            return True
    raise TooManyConflicts(path)


def _forget(spark: SparkSession, path: str, grace: timedelta) -> None:
    until, (number, newest) = time.time() - grace.total_seconds(), read_links(spark, path)
    named = set(newest.loads)
    if number > 1:
        named |= set(json.loads(read_bytes(spark, f"{path}/manifests/manifest={number - 1}"))["loads"])
    for name, changed in listing(spark, f"{path}/loads"):
        if name.startswith(f"{LOAD}=") and name.split("=")[1] not in named and changed <= until:
            remove(spark, f"{path}/loads/{name}")
    for name, changed in listing(spark, f"{path}/manifests"):
        if name.startswith("manifest=") and int(name.split("=")[1]) < number - 1 and changed <= until:
            remove(spark, f"{path}/manifests/{name}")
