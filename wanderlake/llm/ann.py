"""Nearest neighbours by inner product, through low-dimensional stable projections.

Largest inner product becomes nearest neighbour: a vector x gets one more component,
sqrt(M^2 - |x|^2) with M the largest norm, and a query is scaled to norm M. All points then
lie on one sphere, and distance falls as the inner product grows. Gaussian projections to a
few dimensions keep distances in law: the projected squared distance of two points divided by
their true one follows the chi-square distribution with that many degrees of freedom.

* The projections of all rows are indexed by a kd-tree. Its top is split on a bounded sample,
  so it cuts the rows into cells; large cells are dealt into blocks by hash, and every block
  builds the rest of the tree over its own rows.
* A search visits leaves in the order of their least projected distance and verifies what it
  meets by the true inner product. It stops when a point as near as the worst of the k found
  would, with probability 1 - miss, already have been met: projected distance^2 >= quantile of
  chi-square times the k-th true distance^2.
* First every query searches one block of its own cell, which bounds its k-th distance. Then
  it goes to the blocks of all cells that the same test does not rule out.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wanderlake.llm.common import ship, written


@dataclass(frozen=True)
class Settings:
    """``miss``: chance that the stopping test leaves out a neighbour at the k-th distance."""

    k: int = 20
    dimensions: int = 10  # even
    miss: float = 0.01
    seed: int = 5
    sample_rows: int = 8192
    block_rows: int = 8192
    most_cells: int = 1024
    leaf_rows: int = 128
    queries_of_a_task: int = 4096


def chi_square_quantile(p: float, degrees: int) -> float:
    """The value that a chi-square variable of an even number of degrees stays under with chance p."""

    def below(x: float) -> float:
        term = total = exp(-x / 2)
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    low, high = 0.0, 10.0 * degrees + 200
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


@dataclass
class Space:
    """Projection of all vectors of one dimension, with the cells of the tree's top."""

    width: int
    norm2: float
    planes: np.ndarray
    splits: list[tuple[int, float]]  # by place in a complete binary tree, the root first
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    blocks: np.ndarray | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0))
        return x @ self.planes[:-1] + rest[:, None] * self.planes[-1]

    def project_query(self, q: np.ndarray) -> np.ndarray:
        return q * np.sqrt(self.norm2 / (q * q).sum(axis=1))[:, None] @ self.planes[:-1]

    def cell(self, projected: np.ndarray) -> np.ndarray:
        node = np.zeros(len(projected), np.int64)
        axes, values = np.array([s[0] for s in self.splits], int), np.array([s[1] for s in self.splits])
        for _ in range((len(self.splits) + 1).bit_length() - 1):
            node = 2 * node + 1 + (projected[np.arange(len(node)), axes[node]] > values[node])
        return node - len(self.splits)


def split_top(sample: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Medians of the widest axis, level by level, of a complete tree."""
    splits, level = [], [sample]
    for _ in range(depth):
        below = []
        for part in level:
            axis = int(np.ptp(part, axis=0).argmax()) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            splits.append((axis, value))
            right = part[:, axis] > value if len(part) else np.zeros(0, bool)
            below += [part[~right], part[right]]
        level = below
    return splits


def leaves_of(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree, split at the median of the widest axis."""
    open_nodes, leaves = [np.arange(len(points))], []
    while open_nodes:
        rows = open_nodes.pop()
        if len(rows) <= most:
            leaves.append(rows)
            continue
        axis = np.ptp(points[rows], axis=0).argmax()
        order = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
        open_nodes += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return leaves


def box_distance2(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least squared distance of every point in ``q`` to every box."""
    out = np.zeros((len(q), len(low)))
    for axis in range(q.shape[1]):
        x = q[:, axis, None]
        gap = np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0)
        out += gap * gap
    return out


class BlockIndex:
    """The lower part of the kd-tree over the rows of one block."""

    def __init__(self, space: Space, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        self.space, self.ids, self.vectors, self.settings = space, ids, vectors, settings
        points = space.project(vectors)
        self.leaves = leaves_of(points, settings.leaf_rows)
        self.low = np.array([points[rows].min(axis=0) for rows in self.leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in self.leaves])
        self.reach = chi_square_quantile(1 - settings.miss, settings.dimensions)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of every query, as flat arrays of query place, id and score.

        ``floor`` is a score that the k-th neighbour is known to reach (-inf if none is).
        """
        k, norm2 = self.settings.k, self.space.norm2
        scale = np.sqrt(norm2 / (queries * queries).sum(axis=1))
        near = box_distance2(self.space.project_query(queries), self.low, self.high)
        order = np.argsort(near, axis=1, kind="stable")
        who, found, score, floor = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), floor.copy()
        active = np.arange(len(queries))
        for step in range(len(self.leaves)):
            worst2 = np.where(np.isfinite(floor), np.maximum(2 * norm2 - 2 * scale * np.where(np.isfinite(floor), floor, 0), 0), np.inf)
            leaf = order[active, step]
            going = near[active, leaf] <= self.reach * worst2[active] * (1 + 1e-9) + 1e-12 * norm2
            active, leaf = active[going], leaf[going]
            if not len(active):
                break
            by_leaf = np.argsort(leaf, kind="stable")
            news = []
            for part in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
                mine, rows = active[part], self.leaves[leaf[part[0]]]
                products = np.einsum("qd,nd->qn", queries[mine], self.vectors[rows])
                good = (products >= floor[mine, None]) & (self.ids[rows] != query_ids[mine, None])
                a, b = np.nonzero(good)
                news.append((mine[a], self.ids[rows[b]], products[a, b]))
            who = np.concatenate([who, *(n[0] for n in news)])
            found = np.concatenate([found, *(n[1] for n in news)])
            score = np.concatenate([score, *(n[2] for n in news)])
            best = np.lexsort((found, -score, who))
            who, found, score = who[best], found[best], score[best]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            last = rank == k - 1
            floor[who[last]] = np.maximum(floor[who[last]], score[last])
            kept = rank < k
            who, found, score = who[kept], found[kept], score[kept]
        return who, found, score


def _usable(batches, settings):
    """Vectors as doubles in bytes; null, empty, zero and non-finite ones are left out."""
    for batch in batches:
        rows = []
        for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key is None or not vector or None in vector:
                continue
            x = np.array(vector, np.float64)
            if np.isfinite(x).all() and x.any():
                rows.append((key, len(x), float((x * x).sum()), x.tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = (pa.int64(), pa.int32(), pa.float64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["vec_id", "width", "norm2", "vec"])


def _matrix(packed, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, width)


def build_spaces(vectors: DataFrame, settings: Settings) -> dict[int, Space]:
    """For every vector length: random planes, and the tree's top fitted on a sample.

    At most ``sample_rows`` projected vectors come to the driver, those with the smallest hash
    of their id; boxes and counts come as one row for each cell.
    """
    stats = vectors.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("norm2")).collect()
    spaces, m = {}, settings.dimensions
    for r in stats:
        rng = np.random.default_rng([settings.seed, r["width"]])
        spaces[r["width"]] = Space(r["width"], r["norm2"], rng.standard_normal((r["width"] + 1, m)), [])
    sampled = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample_rows)
    shared = vectors.sparkSession.sparkContext.broadcast(spaces)

    def projected(batches):
        for batch in batches:
            widths = batch.column(1).to_pylist()
            points = [shared.value[w].project(_matrix([v], w))[0].tolist() for w, v in zip(widths, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(points, pa.list_(pa.float64()))], names=["width", "point"])

    sample = sampled.mapInArrow(projected, "width int, point array<double>").collect()
    for r in stats:
        points = np.array([s["point"] for s in sample if s["width"] == r["width"]]).reshape(-1, m)
        cells = min(settings.most_cells, max(1, r["n"] // (settings.block_rows // 2)))
        spaces[r["width"]].splits = split_top(points, cells.bit_length() - 1)
    return spaces


def _placed(vectors: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """Every row with its cell."""
    shared = vectors.sparkSession.sparkContext.broadcast(spaces)

    def run(batches):
        for batch in batches:
            widths, packed = batch.column(1).to_numpy(), batch.column(3).to_pylist()
            cells = np.zeros(len(widths), np.int64)
            for w in np.unique(widths):
                rows = np.flatnonzero(widths == w)
                space = shared.value[int(w)]
                cells[rows] = space.cell(space.project(_matrix([packed[i] for i in rows], int(w))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(cells, pa.int32())], names=["vec_id", "width", "vec", "cell"])

    return vectors.mapInArrow(run, "vec_id long, width int, vec binary, cell int")


def _boxes(placed: DataFrame, spaces: dict[int, Space], settings: Settings) -> None:
    """Fill in every cell's box and number of blocks, aggregated over all rows."""
    shared, m = placed.sparkSession.sparkContext.broadcast(spaces), settings.dimensions
    names = ["width", "cell", "n", *(f"low{i}" for i in range(m)), *(f"high{i}" for i in range(m))]

    def run(batches):
        for batch in batches:
            widths, cells, packed = batch.column(1).to_numpy(), batch.column(3).to_numpy(), batch.column(2).to_pylist()
            rows = []
            for w, c in sorted(set(zip(widths.tolist(), cells.tolist(), strict=True))):
                points = shared.value[w].project(_matrix([packed[i] for i in np.flatnonzero((widths == w) & (cells == c))], w))
                rows.append((w, c, len(points), *points.min(axis=0), *points.max(axis=0)))
            types = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * (2 * m)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    shape = "width int, cell int, n long, " + ", ".join(f"{c} double" for c in names[3:])
    sums = [F.sum("n").alias("n"), *(F.min(c).alias(c) for c in names[3 : 3 + m]), *(F.max(c).alias(c) for c in names[3 + m :])]
    for space in spaces.values():
        cells = len(space.splits) + 1
        space.low, space.high, space.blocks = np.full((cells, m), np.inf), np.full((cells, m), np.inf), np.zeros(cells, np.int64)
    for r in placed.mapInArrow(run, shape).groupBy("width", "cell").agg(*sums).collect():
        space, c = spaces[r["width"]], r["cell"]
        space.low[c], space.high[c] = [r[f"low{i}"] for i in range(m)], [r[f"high{i}"] for i in range(m)]
        space.blocks[c] = -(-r["n"] // settings.block_rows)


def _search(index: DataFrame, routed: DataFrame, spaces: dict[int, Space], settings: Settings) -> DataFrame:
    """``query_id, vec_id, score``: each routed query's best in its block.

    A block that many queries visit is repeated, once for each ``queries_of_a_task`` of them.
    """
    place, shared = ["width", "cell", "block"], routed.sparkSession.sparkContext.broadcast(spaces)
    visits = routed.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / settings.queries_of_a_task).cast("int").alias("shares"))
    queries = routed.join(visits, place).withColumn("share", F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int")).drop("shares")
    rows = index.join(visits, place).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def search(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        width = int(found["width"].iloc[0])
        block = BlockIndex(shared.value[width], found["vec_id"].to_numpy(), _matrix(found["vec"], width), settings)
        ids = asked["query_id"].to_numpy()
        who, near, score = block.search(ids, _matrix(asked["vec"], width), asked["floor"].to_numpy(float))
        return pd.DataFrame({"query_id": ids[who], "vec_id": near, "score": score})

    keys = [*place, "share"]
    return rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")


def nearest(table: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product of every query.

    Queries are the rows where ``is_query`` (a column over ``vec_id``) holds; candidates are
    all rows with another id. Ranks start at 1, ties go to the smaller id; with fewer
    candidates all of them are returned, if the stopping test (whose chance to miss a
    neighbour is ``settings.miss``) met them. Products are summed in double precision.

    Null, empty and zero vectors, those with null or non-finite components, and rows with a
    null id take no part. Vectors of different lengths are searched apart. Of a repeated query
    id one vector is searched; repeated candidates are listed each. Other columns play no
    part. An empty table gives an empty one.
    """
    spark = table.sparkSession
    ship(spark)
    narrow = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    shape = "vec_id long, width int, norm2 double, vec binary"
    vectors = written(spark, narrow.mapInArrow(lambda batches: _usable(batches, settings), shape), "vectors")
    spaces = build_spaces(vectors, settings)
    placed = written(spark, _placed(vectors, spaces), "placed")
    _boxes(placed, spaces, settings)
    shared = spark.sparkContext.broadcast(spaces)
    reach = chi_square_quantile(1 - settings.miss, settings.dimensions)

    def cells_of(home: bool):
        """Blocks to search: one of the query's own cell, or all that the stopping test leaves."""

        def run(batches):
            for batch in batches:
                out = []
                for query, width, packed, cell, deal, floor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    space = shared.value[width]
                    if home:
                        out.append((query, width, packed, cell, deal % int(space.blocks[cell]), -np.inf))
                        continue
                    q = _matrix([packed], width)
                    near = box_distance2(space.project_query(q), space.low, space.high)[0]
                    scale = np.sqrt(space.norm2 / (q * q).sum())
                    worst2 = np.inf if floor is None else max(2 * space.norm2 - 2 * scale * floor, 0)
                    for c in np.flatnonzero((space.blocks > 0) & (near <= reach * worst2 * (1 + 1e-9) + 1e-12 * space.norm2)):
                        out += [(query, width, packed, int(c), b, -np.inf if floor is None else floor) for b in range(space.blocks[c])]
                columns = list(zip(*out, strict=True)) or [[]] * 6
                types = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "width", "vec", "cell", "block", "floor"])

        return run

    routed_shape = "query_id long, width int, vec binary, cell int, block int, floor double"
    asked = placed.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("width", "vec", "cell")).alias("own"))
    # Rows are dealt by a hash of id and vector: ids in steps, such as those of the queries, spread evenly.
    asked = asked.select("query_id", "own.*").withColumn("deal", F.xxhash64("query_id", "vec"))
    blocks = F.create_map(*[x for w, s in spaces.items() for x in (F.lit(w), F.array(*[F.lit(int(b)) for b in s.blocks]))]) if spaces else None
    if blocks is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # A query starts in the cell where it lies as a row.
    index = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), blocks[F.col("width")][F.col("cell")]).cast("int"))
    first = _search(index, asked.select("*", F.lit(None).cast("double").alias("floor")).mapInArrow(cells_of(True), routed_shape), spaces, settings)
    worst = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= settings.k)
    bounded = written(spark, asked.join(worst.drop("n"), "query_id", "left").select("query_id", "width", "vec", "cell", "deal", "floor"), "bounded")
    found = _search(index, bounded.mapInArrow(cells_of(False), routed_shape), spaces, settings)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")
