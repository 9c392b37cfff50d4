"""Ad-hoc SQL over the stored star schema whose results are kept and used again.

A result is stored under the query's text and the state of the tables it names: the number of
a fact's manifest, the file names of a dimension. A later call with equal text over unchanged
tables reads the stored result and no table, until its life time is over; any load of one of the
tables makes a new result. Texts are compared without regard to blanks outside quotes; a text
with a comment is compared as it is, since there line ends matter.

Functions of the clock or of chance keep their first value for the life time, as in any cache.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.operators.upsert import read_manifest
from wanderlake.plans import star
from wanderlake.session import children, listing, remove
from wanderlake.sources.tables import run_query

LIFE = timedelta(minutes=5)
MOST_READS = 50
_PLACE = "__place"
_QUOTED = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`)""")


class UnstableTables(RuntimeError):
    """The tables changed during every attempt to open them."""


def query(
    spark: SparkSession,
    text: str,
    root: str,
    names: Sequence[str],
    results: str,
    as_of: datetime,
    life: timedelta = LIFE,
) -> DataFrame:
    """Result of ``text``, in which ``{name}`` stands for each of the GOLD tables in ``names``.

    A stored result younger than ``life`` at ``as_of`` (UTC) is read back, in its order if the text
    has one. Otherwise the query runs once, into the store under ``results``, and results of the
    same text and tables that are past their life are removed. Results in which two columns
    share a name cannot be stored; they are returned directly. A faulty query raises, and
    nothing is stored.
    """
    for _ in range(MOST_READS):
        states = {name: table_state(spark, root, name) for name in sorted(names)}
        frames = {name: star.read_gold_table(spark, root, name) for name in states}
        if states == {name: table_state(spark, root, name) for name in states}:
            break
    else:
        raise UnstableTables(root)
    folder = f"{results}/{_digest(text, states)}"
    found = _living(spark, folder, as_of, life)
    if found is None:
        rows = run_query(spark, text, frames)
        if len({c.lower() for c in rows.columns}) < len(rows.columns):
            return rows
        found = f"{folder}/{_seconds(as_of):012d}-{uuid.uuid4().hex}"
        rows.withColumn(_PLACE, F.monotonically_increasing_id()).write.parquet(found)
        _forget(spark, folder, as_of, life)
    stored = spark.read.parquet(found)
    if re.search(r"\border\s+by\b|\bsort\s+by\b", text, re.IGNORECASE):
        stored = stored.orderBy(_PLACE)
    return stored.drop(_PLACE)


def table_state(spark: SparkSession, root: str, name: str) -> str:
    """What changes whenever a load changes the table; read from names alone, without a job."""
    path = f"{root}/{name}"
    if name in star.FACTS:
        return str(read_manifest(spark, path)[0])
    # A rewritten dimension has files of other names.
    return hashlib.sha256("\n".join(sorted(children(spark, path))).encode()).hexdigest()


def normalised(text: str) -> str:
    """The text with one blank wherever there are several outside quotes."""
    parts = _QUOTED.split(text)
    if any("--" in p or "/*" in p for p in parts[::2]):
        return text
    parts[::2] = [re.sub(r"\s+", " ", p) for p in parts[::2]]
    return "".join(parts).strip().rstrip(";").rstrip()


def forget(spark: SparkSession, results: str, as_of: datetime, life: timedelta = LIFE) -> None:
    """Remove all results past their life, also of queries that nobody asks again."""
    for name, _ in listing(spark, results):
        _forget(spark, f"{results}/{name}", as_of, life)
        if not children(spark, f"{results}/{name}"):
            remove(spark, f"{results}/{name}")


def _digest(text: str, states: dict[str, str]) -> str:
    return hashlib.sha256(json.dumps([normalised(text), states]).encode()).hexdigest()


def _seconds(moment: datetime) -> int:
    return int(moment.replace(tzinfo=timezone.utc).timestamp())


def _age(name: str, as_of: datetime) -> int:
    return _seconds(as_of) - int(name.split("-")[0])


def _living(spark: SparkSession, folder: str, as_of: datetime, life: timedelta) -> str | None:
    """The newest whole result within its life; one that is still being written does not count."""
    for name in sorted(children(spark, folder), reverse=True):
        young = 0 <= _age(name, as_of) < life.total_seconds()
        if young and "_SUCCESS" in children(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    return None


def _forget(spark: SparkSession, folder: str, as_of: datetime, life: timedelta) -> None:
    # Twice the life: who found a result at its end may still be reading it.
    for name in children(spark, folder):
        if _age(name, as_of) > 2 * life.total_seconds():
            remove(spark, f"{folder}/{name}")
