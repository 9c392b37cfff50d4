"""Centroid clustering with n-simplex projection.

Vectors become whole numbers. Their distances to a few pivots are measured once and kept: with
the distances between the pivots they give the apex of a simplex over the pivots, a point of as
many coordinates as there are pivots, the last one the height over the pivots' own space. For
two apexes the Euclidean distance is a lower bound of the true distance, and the distance to
the apex mirrored at that space is an upper bound. In a round only centroids whose lower bound
does not exceed the least upper bound are compared, exactly, in integers; most vectors are left
with one centroid, and need no comparison at all until distances are asked for.

A round reads the stored vectors once. Every task adds up its own vectors, so a cluster sends
one row for each task, and 64 sums and a count for each cluster come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderlake.llm.common import ship, staged, written
from wanderlake.session import remove

DIMENSIONS = 64
SCALE = 1024
LARGEST = 1 << 27  # so that a squared distance of 64 components fits 64 bits
SLICE = 8_192
MOST_GROWTH = 1e7


@dataclass(frozen=True)
class Settings:
    """``clusters`` centroids, ``rounds`` of moving them, up to ``pivots`` pivots, the seed of the start."""

    clusters: int = 8
    rounds: int = 10
    pivots: int = 12
    seed: int = 3


def start_hash(vec_id: Column, seed: int) -> Column:
    """Lower-case hex SHA-256 of ``seed:vec_id``; null for a null id."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")).cast("binary"), 256)


def whole_vectors(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """``vec_id, v``: floor(1024 * x) of vectors with exactly 64 finite components, the others left out.

    A component of 2^27 or more (x of 131,072 or more) has no 64-bit distances; such vectors
    are left out as well.
    """
    x = F.col(f"`{vector}`")
    rows = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.transform(x, lambda c: c.cast("double")).alias("x"))
    # The largest magnitude is NaN, infinite or null where a component is.
    good = F.forall("x", lambda c: F.coalesce((F.abs(c) < LARGEST / SCALE) & ~F.isnan(c), F.lit(False)))
    kept = rows.filter((F.size("x") == DIMENSIONS) & good)
    return kept.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


class Simplex:
    """Apex coordinates over pivots in general position."""

    def __init__(self, candidates: np.ndarray, most: int):
        """Take pivots in turn, leaving out those that lie (nearly) in the span of the ones before.

        ``growth`` is how much rounding errors of the distances can grow in the coordinates; a
        pivot that would let it exceed ``MOST_GROWTH`` is left out.
        """
        self.pivots = np.empty((0, DIMENSIONS), np.int64)
        self.base = np.zeros((0, 0))  # row i: apex of pivot i over the pivots before it, i coordinates
        self.growth = 1.0
        reach = squared(candidates, candidates[:1]) if len(candidates) else np.zeros(1)
        self.scale = max(1.0, float(np.sqrt(reach.max())))
        for vector in candidates:
            if len(self.pivots) == most:
                break
            n = len(self.pivots)
            if n == 0:
                self.pivots, self.base = vector[None, :], np.zeros((1, 0))
                continue
            apex = self._apexes(squared(vector[None, :], self.pivots).astype(np.float64))[0]
            grown = self.growth * (1 + self.scale / apex[-1]) if apex[-1] > 0 else np.inf
            if grown <= MOST_GROWTH:
                self.growth = grown
                self.pivots = np.vstack([self.pivots, vector])
                self.base = np.vstack([np.pad(self.base, ((0, 0), (0, n - self.base.shape[1]))), apex])

    def _apexes(self, squares: np.ndarray) -> np.ndarray:
        """Apexes from squared distances to all pivots: one row and one coordinate for each pivot.

        |x - p_i|^2 = |x|^2 + |p_i|^2 - 2 x.p_i with the first pivot as origin gives the inner
        products, and the triangular base gives coordinate after coordinate.
        """
        n = len(self.base)
        out = np.zeros((len(squares), n))
        norms = np.square(self.base).sum(axis=1)
        for i in range(1, n):
            inner = (squares[:, 0] + norms[i] - squares[:, i]) / 2
            inner -= out[:, : i - 1] @ self.base[i, : i - 1]
            out[:, i - 1] = inner / self.base[i, i - 1]
        out[:, n - 1] = np.sqrt(np.maximum(squares[:, 0] - np.square(out[:, : n - 1]).sum(axis=1), 0))
        return out

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.pivots):
            return np.zeros((len(vectors), 1))
        return self._apexes(squared(vectors, self.pivots).astype(np.float64))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``, in integers."""
    out = np.empty((len(a), len(b)), np.int64)
    for j, row in enumerate(b):
        off = a - row
        out[:, j] = np.einsum("ij,ij->i", off, off)
    return out


def candidates_of(apexes: np.ndarray, centres: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Which centroids may be nearest: a row for each vector, a column for each centroid.

    Bounds are widened by what rounding in floating point can take.
    """
    flat = np.empty((len(apexes), len(centres)))
    for j, centre in enumerate(centres):
        flat[:, j] = np.square(apexes[:, :-1] - centre[:-1]).sum(axis=1)
    low = flat + np.square(apexes[:, -1:] - centres[:, -1])
    high = flat + np.square(apexes[:, -1:] + centres[:, -1])
    size = np.square(apexes).sum(axis=1, keepdims=True) + np.square(centres).sum(axis=1)
    room = 64 * np.finfo(float).eps * simplex.growth * size * (1 + np.sqrt(size) / simplex.scale) + 1.0
    return low - room <= (high + room).min(axis=1, keepdims=True)


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Number of the nearest centroid of every vector, the smaller number of equally near ones."""
    open_ = candidates_of(apexes, centres, simplex)
    best = open_.argmax(axis=1)
    many = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(many):
        least = np.full(len(many), np.iinfo(np.int64).max)
        for j in range(len(centroids)):
            at = np.flatnonzero(open_[many, j])
            off = vectors[many[at]] - centroids[j]
            exact = np.einsum("ij,ij->i", off, off)
            closer = exact < least[at]
            least[at[closer]], best[many[at[closer]]] = exact[closer], j
    return best


def _arrays(batch: pa.RecordBatch, pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        vectors = np.frombuffer(b"".join(part.column(1).to_pylist()), "<i4").reshape(-1, DIMENSIONS).astype(np.int64)
        yield part, vectors, np.frombuffer(b"".join(part.column(2).to_pylist()), "<f8").reshape(-1, pivots)


def cluster(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", settings: Settings = Settings()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every kept vector.

    Kept are vectors with exactly 64 components, none null or non-finite (and none of 131,072 or
    more, whose distances would not fit a long). The first centroids are the kept vectors with
    the smallest hash of their id (``start_hash``; null ids last, equal hashes by components).
    With fewer vectors than clusters there are as many clusters as vectors. ``distance`` is the
    exact squared distance to the final centroid. Repeated rows count each and get equal
    results; a null id is carried through; an empty table, or one without a kept vector, gives
    an empty one. Other columns of the table play no part.
    """
    spark, kind = df.sparkSession, df.schema[vec_id].dataType.simpleString()
    shape = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    rows = whole_vectors(df, vector, vec_id)
    order = (start_hash(F.col("vec_id"), settings.seed).asc_nulls_last(), F.col("v"))
    first = np.array([r["v"] for r in rows.orderBy(*order).limit(settings.clusters + settings.pivots).collect()], np.int64).reshape(-1, DIMENSIONS)
    centroids = first[: settings.clusters].copy()
    if not len(centroids):
        return spark.createDataFrame([], shape)
    simplex = Simplex(first, settings.pivots)
    pivots = max(len(simplex.pivots), 1)
    ship(spark)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                vectors = part.column(1).flatten().to_numpy().reshape(-1, DIMENSIONS)
                packed = [row.tobytes() for row in vectors.astype("<i4")]
                apexes = [row.tobytes() for row in simplex.apexes(vectors)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary()), pa.array(apexes, pa.binary())], names=["vec_id", "v", "apex"])

    stored, stored_at = staged(spark, rows.mapInArrow(project, f"vec_id {kind}, v binary, apex binary"), "vectors")
    for _ in range(settings.rounds):
        moved = _moved(stored, centroids, simplex, pivots)
        if np.array_equal(moved, centroids):  # nothing would change in the rounds left
            break
        centroids = moved
    final = written(spark, _assigned(stored, centroids, simplex, pivots, kind), "assigned")
    remove(spark, stored_at)
    inertias = {r["cluster"]: int(r["s"]) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    total = sum(inertias.values())
    shown = spark.createDataFrame([(c, s, total, names[c]) for c, s in inertias.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(shown), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(stored: DataFrame, centroids: np.ndarray, simplex: Simplex, pivots: int) -> np.ndarray:
    """Centroids after one round: componentwise floor of the mean of their vectors, exactly."""
    centres, k = simplex.apexes(centroids), len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, DIMENSIONS), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, vectors, apexes in _arrays(batch, pivots):
                best = nearest(vectors, apexes, centroids, centres, simplex)
                for j in range(k):
                    total[j] += vectors[best == j].sum(axis=0)
                count += np.bincount(best, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(list(total[some]), pa.list_(pa.int64())), pa.array(count[some], pa.int64())],
            names=["cluster", "total", "n"],
        )

    parts = stored.mapInArrow(sums, "cluster int, total array<long>, n long")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"c{i}") for i in range(DIMENSIONS)]
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():
        out[r["cluster"]] = [int(r[f"c{i}"]) // r["n"] for i in range(DIMENSIONS)]
    return out


def _assigned(stored: DataFrame, centroids: np.ndarray, simplex: Simplex, pivots: int, kind: str) -> DataFrame:
    """``vec_id, cluster, distance`` to the given centroids."""
    centres = simplex.apexes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, vectors, apexes in _arrays(batch, pivots):
                best = nearest(vectors, apexes, centroids, centres, simplex)
                off = vectors - centroids[best]
                exact = np.einsum("ij,ij->i", off, off)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best, pa.int32()), pa.array(exact, pa.int64())], names=["vec_id", "cluster", "distance"])

    return stored.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")
