"""MinHash near-duplicates with sequential Bayesian verification.

1. A document is the set of its different word shingles, hashed to 64 bits. Documents with
   equal sets are one class from here on, represented by its smallest id.
2. MinHash signatures are cut into bands; representatives that agree on a band share a bucket.
3. In every bucket a hub, chosen by hash, meets all other members. A pair's signatures are
   compared batch by batch: with m of n hashes equal and an even prior, the chance that the
   true similarity reaches the threshold is a binomial tail, and a pair whose chance falls
   under the miss probability is pruned. Survivors are verified on their full sets.
4. Verified links join components. Buckets whose members ended in different components are
   taken again, exhaustively: every pair of members in different components is compared (in
   tasks of two bounded blocks), pruned and verified the same way, and joins components as
   soon as it is verified. Pairs never leave the task; links do.

So a large group of copies costs one comparison for each member and band, and only members
that no hub could place are compared with all others.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.llm.common import ship, staged, words_of, written
from wanderlake.llm.components import connected
from wanderlake.session import remove

_P1, _P2, _P3, _P4 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63))
_HALF = np.uint64(32)


# Ids of candidates (some tens of bytes each) that may be broadcast to the scan of the texts.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity; ``miss`` the chance at which a pair is pruned."""

    shingle: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 5
    miss: float = 1e-4
    seed: int = 7
    block: int = 1024

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    """64-bit hashes of the words met so far; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P4
    return x ^ (x >> np.uint64(29))


def shingle_set(words: list[bytes], size: int, hashes: dict) -> np.ndarray:
    """Sorted hashes of all different runs of ``size`` words; the whole text as one if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    ids = np.array([hashes[w] for w in words], np.uint64)
    run = min(size, len(ids))
    total = np.full(len(ids) - run + 1, run, np.uint64)
    for k in range(run):
        total = _mix(total * _P1 + ids[k : k + len(total)] * _P2 + _P3)
    return np.unique(total)


class Signer:
    """MinHash signatures, unsigned 32-bit."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.odd = rng.integers(0, 2**63, (settings.hashes, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 2**63, (settings.hashes, 1), dtype=np.uint64)

    def sign(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.odd), 0xFFFFFFFF, np.uint64)
        for at in range(0, len(grams), 2048):
            hashed = grams[at : at + 2048] * self.odd
            hashed += self.plus
            np.minimum(least, hashed.min(axis=1) >> _HALF, out=least)
        return least.astype("<u4")


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """After n hashes, how many must be equal: (n, least) for every band's end of five.

    With an even prior, P(similarity >= t | m of n equal) = P(Binomial(n + 1, t) <= m).
    """
    t, out = settings.percent / 100, []
    for n in range(25, settings.hashes + 1, 25):
        tail, m = (1 - t) ** (n + 1), 0
        while tail < settings.miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def plausible(left: np.ndarray, right: np.ndarray, checks: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of signatures survive; each batch looks only at what the one before left."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in checks:
        matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive, done = alive[matches[alive] >= least], n
    return alive


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted arrays of different values."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, text: str, doc_id: str, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_key, signature``; key and signature are null for an empty set."""

    def run(batches):
        hashes, signer = _WordHashes(), Signer(settings)
        for batch in batches:
            counts, keys, signs = [], [], []
            for value in batch.column(1):
                grams = shingle_set(words_of(value.as_py()), settings.shingle, hashes)
                counts.append(len(grams))
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                signs.append(signer.sign(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    ship(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_shingles long, set_key binary, signature binary")


def _sets(docs: DataFrame, text: str, doc_id: str, ids: DataFrame, settings: Settings) -> DataFrame:
    """``rep, grams`` of the representatives in ``ids`` (stored, ``rep, set_key``), from their texts."""

    def run(batches):
        hashes = _WordHashes()
        for batch in batches:
            grams = [shingle_set(words_of(v.as_py()), settings.shingle, hashes).tobytes() for v in batch.column(1)]
            keys = [xxhash.xxh3_128_digest(g) for g in grams]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(grams, pa.binary())], names=["rep", "set_key", "grams"])

    # Counted from file footers: within the bound the texts stay where they are, beyond it they
    # are shuffled to the ids.
    few = F.broadcast if ids.count() <= BROADCAST_IDS else lambda side: side
    texts = docs.select(F.col(doc_id).alias("rep"), F.col(text).alias("text")).join(few(ids.select("rep").distinct()), "rep", "left_semi")
    kind = texts.schema["rep"].dataType.simpleString()
    made = texts.mapInArrow(run, f"rep {kind}, set_key binary, grams binary").join(few(ids), ["rep", "set_key"], "left_semi")
    return made.dropDuplicates(["rep", "set_key"]).drop("set_key")


def _pruned(pairs: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    checks = least_matches(settings)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).take(pa.array(plausible(left, right, checks)))

    left = signed.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    right = signed.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, pairs.schema)


def _verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                good = [
                    similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), settings.percent)
                    for x, y in zip(part.column(2), part.column(3), strict=True)
                ]
                yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("rep").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ga", "gb").mapInArrow(run, pairs.schema)


class _Groups:
    """Components inside one task: the smallest label stands for its set."""

    def __init__(self, labels: np.ndarray):
        self.labels = labels.copy()

    def join(self, x: int, y: int) -> None:
        a, b = sorted((self.labels[x], self.labels[y]))
        self.labels[self.labels == b] = a


def links_in_block(frame: pd.DataFrame, settings: Settings, checks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links (by component) between members of one bucket that are in different components.

    ``frame``: band, side (0 or 1; both blocks may be one), component, n_shingles, signature,
    grams. A pair is compared only in the first band that it shares, so its other buckets skip it.
    """
    frame = frame.sort_values(["component", "rep"], kind="stable").reset_index(drop=True)
    signs = np.frombuffer(b"".join(frame["signature"]), "<u4").reshape(len(frame), -1)
    sizes, side = frame["n_shingles"].to_numpy(), frame["side"].to_numpy()
    grams = [np.frombuffer(g, np.uint64) for g in frame["grams"]]
    names, start = np.unique(frame["component"].to_numpy(), return_inverse=True)
    groups, band, links = _Groups(start), int(frame["band"].iloc[0]), []
    two_sided = (side == 1).any() and (side == 0).any()
    for x in range(len(frame) - 1):
        rest = np.arange(x + 1, len(frame))
        near = (groups.labels[rest] != groups.labels[x]) & (100 * np.minimum(sizes[rest], sizes[x]) >= settings.percent * np.maximum(sizes[rest], sizes[x]))
        if two_sided:
            near &= side[rest] != side[x]
        rest = rest[near]
        if not len(rest):
            continue
        same = (signs[rest] == signs[x]).reshape(len(rest), settings.bands, settings.rows).all(axis=2)
        rest = rest[same.argmax(axis=1) == band]
        for y in rest[plausible(np.broadcast_to(signs[x], (len(rest), signs.shape[1])), signs[rest], checks)]:
            if groups.labels[x] != groups.labels[y] and similar(grams[x], grams[y], settings.percent):
                links.append((names[start[x]], names[start[y]]))
                groups.join(x, y)
    return links


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """One row for each document: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links reach from the document's text; ``kept`` is
    true where it is the document's own. A null, empty or wordless text has no shingles and is
    linked with nothing. A row with a null id is linked with nothing either: its component is
    null, and it is kept. Repeated rows get equal results; a text shorter than a shingle is one
    shingle. Other columns of ``docs`` play no part. An empty table gives an empty one.
    """
    spark, schema = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    signed = written(spark, signatures(docs, text, doc_id, settings), "signatures")
    usable = signed.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    first = F.struct("n_shingles", "signature")
    reps = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first(first).alias("own")).select("set_key", "rep", "own.*")
    reps, reps_at = staged(spark, reps, "representatives")

    width = settings.rows * 4
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(settings.bands - 1)),
        lambda i: F.struct(i.alias("band"), F.xxhash64(i, F.substring(F.col("signature"), i * width + 1, F.lit(width))).alias("key")),
    )
    banded = reps.select("rep", "set_key", "n_shingles", F.explode(keys).alias("k")).select("rep", "set_key", "n_shingles", "k.*")
    order = F.xxhash64("rep", "key")
    buckets = banded.groupBy("key").agg(F.min_by("rep", order).alias("hub"), F.min_by("n_shingles", order).alias("hub_n"), F.count(F.lit(1)).alias("members"))
    members, members_at = staged(spark, banded.join(buckets.filter("members > 1"), "key"), "buckets")

    small, large = F.least("n_shingles", "hub_n"), F.greatest("n_shingles", "hub_n")
    pairs = members.filter((F.col("rep") != F.col("hub")) & (100 * small >= settings.percent * large))
    pairs = pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    shown = reps.select("rep", "signature")
    survivors, survivors_at = staged(spark, _pruned(pairs, shown, settings), "survivors")
    candidates, candidates_at = staged(spark, members.select("rep", "set_key").distinct(), "candidates")
    sets, sets_at = staged(spark, _sets(docs, text, doc_id, candidates, settings), "sets")
    placed = written(spark, connected(_verified(survivors, sets, settings)), "components")

    # Buckets with members in different components, of which some pair was not compared yet.
    labelled = members.join(placed.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    blocks = F.ceil(F.col("members") / settings.block).cast("int")
    open_rows = labelled.filter("members > 2").join(mixed, "key").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tasks = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(other, F.col("own")).alias("i"), F.greatest(other, F.col("own")).alias("j"), (F.col("own") > other).cast("int").alias("side")),
    )
    open_rows = open_rows.withColumn("own", own).withColumn("task", F.explode(tasks)).select("key", "band", "rep", "component", "n_shingles", "task.*")
    open_rows = open_rows.join(shown, "rep").join(sets, "rep")
    checks = least_matches(settings)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(links_in_block(frame, settings, checks), columns=["a", "b"])

    more = connected(open_rows.groupBy("key", "i", "j").applyInPandas(compare, f"a {schema}, b {schema}"))
    for folder in (reps_at, members_at, survivors_at, candidates_at, sets_at):
        remove(spark, folder)
    joined = more.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    final = placed.join(joined, "component", "left").select(F.col("node").alias("rep"), F.coalesce("joined", "component").alias("component_id"))
    alone = joined.join(placed.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("rep"), F.col("joined").alias("component_id"))

    named = signed.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left").join(final.union(alone), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep", "doc_id")).alias("component_id")
    return named.select("doc_id", "n_shingles", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
