"""Mixing sources to target weights by fitting a subset sum of document lengths.

Every source gets a target of words. It is met with whole documents: as many full copies of
the source as fit, then a subset for the rest. The subset is chosen by length alone: documents
are counted by exact length, each length gives its proportional share, and the budget that
rounding leaves is filled by bounded-knapsack dynamic programming over the lengths still
unused. A remainder beyond what that fills meets the shortest unused document, if overshooting is
nearer. Where the target is still missed, the whole remainder after the proportional shares is
filled again (exactly while its masks have ``MASK_BITS``, else in units of several words), and
the nearer choice counts. Which documents of a length are taken follows a seeded hash.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wanderlake.llm.common import ship, written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
DP_BUDGET = 20_000
MASK_BITS = 1 << 28
ROWS_OF_A_BUCKET = 5_000


def word_count(text: str | Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fill(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take, so that their sum comes closest to ``budget``.

    Bounded knapsack: bit b of a mask says that the sum b can be reached. Counts are split in
    powers of two; the masks before each item tell on the way back whether it was used. Sums
    over twice the budget are farther than none; of two equally close ones the smaller is taken.
    """
    mask, full, items, before = 1, (1 << 2 * budget + 1) - 1, [], []
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        count, step = min(count, 2 * budget // length), 1
        while count > 0 and not mask >> budget & 1:
            k = min(step, count)
            before.append(mask)
            items.append((i, k))
            mask |= (mask << length * k) & full
            count, step = count - k, step * 2
    under = (mask & (1 << budget + 1) - 1).bit_length() - 1
    over = mask >> budget
    above = budget + (over & -over).bit_length() - 1 if over else 3 * budget + 1
    taken, left = [0] * len(lengths), under if budget - under <= above - budget else above
    for (i, k), old in zip(reversed(items), reversed(before), strict=True):
        if not old >> left & 1:
            taken[i] += k
            left -= lengths[i] * k
    return taken


def plan_source(lengths: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """Full copies of all documents, and how many documents of each length are taken once more."""
    size = int((lengths * counts).sum())
    extra = np.zeros(len(lengths), np.int64)
    if not size:
        return 0, extra
    copies, rest = divmod(min(round(target), MOST_COPIES * size), size)
    if not rest:
        return int(copies), extra
    share = counts * rest / size
    extra = np.where(lengths > 0, np.floor(share), 0).astype(np.int64)
    left = int(rest - (lengths * extra).sum())
    floor, gap = extra.copy(), left
    order = np.lexsort((lengths, extra - share))  # the largest fraction first
    moved = True
    while left > DP_BUDGET and moved:
        moved = False
        for i in order:
            if left > DP_BUDGET and 0 < lengths[i] <= left and extra[i] < counts[i]:
                extra[i] += 1
                left -= int(lengths[i])
                moved = True
    able = np.flatnonzero((lengths > 0) & (lengths <= 2 * left) & (extra < counts))
    if left <= DP_BUDGET and len(able):
        extra[able] += fill(lengths[able].tolist(), (counts - extra)[able].tolist(), left)
    off = abs(int(rest - (lengths * extra).sum()))
    if off:
        again = floor + refill(lengths, counts - floor, gap)
        if abs(int(rest - (lengths * again).sum())) < off:
            extra = again
    return int(copies), extra


def refill(lengths: np.ndarray, unused: np.ndarray, gap: int) -> np.ndarray:
    """``fill`` over all unused documents, in units of as many words as keep the masks bounded."""
    taken = np.zeros(len(lengths), np.int64)
    able = np.flatnonzero((lengths > 0) & (lengths <= 2 * gap) & (unused > 0))
    if len(able):
        items = sum(int(min(n, 2 * gap // size)).bit_length() for n, size in zip(unused[able], lengths[able], strict=True))
        unit = ceil(2 * gap * items / MASK_BITS)
        units = np.maximum(np.rint(lengths[able] / unit), 1).astype(np.int64)
        taken[able] = fill(units.tolist(), unused[able].tolist(), round(gap / unit))
    return taken


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code-point order, null last, have the weights in turn and share the sum of all
    sizes. No target exceeds ``MOST_COPIES`` times its source's size; what is over goes to the
    others by weight, until none is above. Sources are ranked and summed as a table; one row of
    sums for each round comes to the driver.
    """
    spark, schema = sources.sparkSession, sources.select("source", "source_size").schema
    ranked = sources.select("source", "source_size").orderBy(F.col("source").isNull(), "source").rdd.zipWithIndex()
    ranked = ranked.map(lambda pair: (*pair[0], weights[pair[1] % len(weights)]))
    ranked = written(spark, spark.createDataFrame(ranked, T.StructType([*schema.fields, T.StructField("weight", T.LongType())])), "sources")
    row = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level = int(row[0] or 0), 0.0
    if total:
        level, capped = total / row[1], -1
        while True:
            full = MOST_COPIES * F.col("source_size") <= F.col("weight") * F.lit(level)
            row = ranked.agg(
                F.count(F.when(full, 1)),
                F.sum(F.when(full, MOST_COPIES * F.col("source_size")).otherwise(0)),
                F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            ).first()
            if row[0] == capped or not row[2]:
                break
            capped, level = row[0], (total - int(row[1])) / int(row[2])
    target = F.least(MOST_COPIES * F.col("source_size").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, seed: int = 11) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` (0 to 3) to every row.

    A row is taken ``copies`` times; the words taken of a source come as close to its target as
    whole documents allow. Rows without words are never taken. A null source is a source of its
    own. Repeated rows are documents of their own, each counted. An empty table gives an empty
    one. Reruns agree: the choice depends on ids and the seed alone. Columns with the added
    names are replaced.

    A hot source or length is counted before the shuffle. Only hashes and ids are ordered, in
    buckets of bounded size; whole rows stay where they are.
    """
    ship(docs.sparkSession)
    added = ("size", "source_size", "target", "copies")
    kept = [c for c in docs.columns if c not in added or c in (source, doc_id)]
    # One key for a source, null included: a bar before the name.
    key = F.when(F.col(source).isNotNull(), F.concat(F.lit("|"), F.col(source).cast("string"))).otherwise(F.lit(""))
    rows = docs.withColumn("_wl_size", size).withColumn("_wl_source", key).withColumn("_wl_hash", F.xxhash64(F.lit(seed), F.col(doc_id)))
    lengths = written(docs.sparkSession, rows.groupBy("_wl_source", "_wl_size").agg(F.count(F.lit(1)).alias("n"), F.first(source).alias("source")), "lengths")
    sizes = lengths.groupBy("_wl_source").agg(F.first("source").alias("source"), F.sum(F.col("_wl_size") * F.col("n")).alias("source_size"))
    goals = targets(sizes, weights)
    goals = goals.withColumn("_wl_source", F.when(F.col("source").isNotNull(), F.concat(F.lit("|"), F.col("source").cast("string"))).otherwise(F.lit("")))

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_wl_size", ignore_index=True)
        copies, extra = plan_source(frame["_wl_size"].to_numpy(), frame["n"].to_numpy(), float(frame["target"].iloc[0]))
        frame["copies"], frame["extra"] = np.where(frame["_wl_size"] > 0, copies, 0), extra
        frame["buckets"] = [ceil(n / ROWS_OF_A_BUCKET) if 0 < e < n else 1 for n, e in zip(frame["n"], frame["extra"], strict=True)]
        return frame[["_wl_source", "_wl_size", "source_size", "target", "n", "copies", "extra", "buckets"]]

    shape = "_wl_source string, _wl_size long, source_size long, target double, n long, copies long, extra long, buckets int"
    by_length = lengths.select("_wl_source", "_wl_size", "n").join(goals.drop("source"), "_wl_source")
    plan = written(docs.sparkSession, by_length.groupBy("_wl_source").applyInPandas(choose, shape), "plan")

    place = ["_wl_source", "_wl_size"]
    plan = plan.select(*place, *(F.col(c).alias(f"_wl_{c}") for c in ("source_size", "target", "n", "copies", "extra", "buckets")))
    ranked = (F.col("_wl_extra") > 0) & (F.col("_wl_extra") < F.col("_wl_n"))
    cuts = written(docs.sparkSession, _cuts(rows.select(*place, "_wl_hash", F.col(doc_id).alias("_wl_id")).join(plan.filter(ranked), place)), "cuts")
    placed = rows.join(plan, place).join(cuts, place, "left")
    at_cut = (F.col("_wl_hash") == F.col("_wl_cut_hash")) & F.col(doc_id).eqNullSafe(F.col("_wl_cut_id"))
    torn = F.coalesce(at_cut & (F.col("_wl_cut_take") < F.col("_wl_cut_same")), F.lit(False))
    lower = F.coalesce(F.col(doc_id) < F.col("_wl_cut_id"), F.col(doc_id).isNull() & F.col("_wl_cut_id").isNotNull())
    before = (F.col("_wl_hash") < F.col("_wl_cut_hash")) | ((F.col("_wl_hash") == F.col("_wl_cut_hash")) & lower)
    more = F.when(ranked, before | at_cut).otherwise(F.col("_wl_extra") > 0)
    if cuts.filter("_wl_cut_take < _wl_cut_same").isEmpty():
        placed = placed.withColumn("_wl_more", more.cast("long"))
    else:
        # Only rows that share their id with others at a cut need a number of their own.
        number = F.row_number().over(Window.partitionBy(*place).orderBy("_wl_hash", doc_id))
        apart = placed.filter(torn).withColumn("_wl_more", (number <= F.col("_wl_cut_take")).cast("long"))
        placed = placed.filter(~torn).withColumn("_wl_more", more.cast("long")).unionByName(apart)
    more = F.when(F.col("_wl_size") > 0, F.col("_wl_copies") + F.col("_wl_more")).otherwise(F.lit(0))
    return placed.select(
        *(F.col(f"`{c}`") for c in kept),
        F.col("_wl_size").alias("size"),
        F.col("_wl_source_size").alias("source_size"),
        F.col("_wl_target").alias("target"),
        more.cast("int").alias("copies"),
    )


def _cuts(rows: DataFrame) -> DataFrame:
    """Where to cut each length of which only some documents are taken, in the order of hash and id.

    ``rows`` has hash and id of those documents, with their plan. All before ``_wl_cut_hash, _wl_cut_id``
    are taken, and ``_wl_cut_take`` of the ``_wl_cut_same`` rows that have this hash and id. Buckets
    follow the order of the hashes, so no task orders more than one of them.
    """
    place = ["_wl_source", "_wl_size"]
    bucket = F.least(F.floor((F.col("_wl_hash") / F.lit(2.0**64) + 0.5) * F.col("_wl_buckets")), F.col("_wl_buckets") - 1)
    same = rows.groupBy(*place, "_wl_hash", "_wl_id").agg(F.count(F.lit(1)).alias("_wl_cut_same"), F.first("_wl_extra").alias("_wl_extra"), F.first(bucket).alias("_wl_bucket"))
    same = written(rows.sparkSession, same, "ids")
    own = same.groupBy(*place, "_wl_bucket").agg(F.sum("_wl_cut_same").alias("_wl_own"))
    earlier = F.sum("_wl_own").over(Window.partitionBy(*place).orderBy("_wl_bucket").rowsBetween(Window.unboundedPreceding, -1))
    same = same.join(own.select(*place, "_wl_bucket", F.coalesce(earlier, F.lit(0)).alias("_wl_earlier")), [*place, "_wl_bucket"])
    order = Window.partitionBy(*place, "_wl_bucket").orderBy("_wl_hash", "_wl_id").rowsBetween(Window.unboundedPreceding, -1)
    take = F.col("_wl_extra") - F.col("_wl_earlier") - F.coalesce(F.sum("_wl_cut_same").over(order), F.lit(0))
    same = same.withColumn("_wl_cut_take", take).filter((F.col("_wl_cut_take") > 0) & (F.col("_wl_cut_take") <= F.col("_wl_cut_same")))
    return same.select(*place, F.col("_wl_hash").alias("_wl_cut_hash"), F.col("_wl_id").alias("_wl_cut_id"), "_wl_cut_take", "_wl_cut_same")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every row of ``mix`` as often as it is taken, with the columns asked for."""
    return mixed.withColumn("_wl_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*(F.col(f"`{c}`") for c in columns))
