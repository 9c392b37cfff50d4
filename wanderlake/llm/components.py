"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderlake.llm.common import staged
from wanderlake.session import remove


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``); the component is its smallest node.

    Alternating large-star and small-star steps: every step points each node's neighbours at
    the smallest node it knows, keeps the number of edges within the nodes, and ends when
    nothing changes, after about log(n) rounds. A round is stored in the shared folder, which
    cuts the lineage, and the one before is removed; only a count and a checksum come to the driver. A hot node is
    pre-aggregated for the minimum, and its edges can be split in the join.
    """
    spark = edges.sparkSession
    edges, folder = staged(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = _mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, between = staged(spark, large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        remove(spark, folder)
        edges, folder = staged(spark, small.filter("u <> v").distinct(), "edges")
        remove(spark, between)
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v"), F.col("v"))).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return int(row[0]), int(row[1] or 0)
