"""Resharding by minimum-cost flow.

Old shards have sizes, new shards have capacities. A flow from old to new that ships every
byte at least cost, where staying is free and moving costs one a byte, says how many bytes
each old shard hands to which new one. Every old shard is laid out in a fixed order and cut
into consecutive blocks of those sizes; what stays comes first. Only shards that hand rows away
are written anew; the others keep their files, and get files of the rows that come to them.

Equal texts stand side by side, and a cut falls before or after all of them. Groups of equal
texts with a large share of the bytes or rows come first, where the part that stays is; when a
cut still falls inside one, it is split, as equal sizes come before whole groups. Large documents
come next and small ones last, so a shard misses its capacity by few bytes.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

ROWS_OF_A_BLOCK = 8_192
BYTES_OF_A_BLOCK = 32 << 20
PARTS_OF_A_SHARD = 64  # a group of a larger share of a shard may be split
MOST_GROUPS = 100_000
OVERHEAD = 8


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) plus a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def min_cost_flow(sizes: dict[int, int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard: all sizes shipped, no capacity exceeded, fewest moved.

    Successive cheapest augmenting paths. Old shard i may stay as new shard i at no cost; other
    moves lead from shards with more than their capacity to shards with less, and cost one a
    byte. The graph has one node for each shard, and shards are few, whatever they hold.
    """
    if sum(sizes.values()) > sum(capacities):
        raise ValueError("the capacities are too small")
    old, new = sorted(sizes), range(len(capacities))
    source, sink = 0, 1 + len(old) + len(capacities)
    graph: list[list[list[int]]] = [[] for _ in range(sink + 1)]  # edges: to, room, cost, place of the reverse edge

    def edge(a: int, b: int, room: int, cost: int) -> None:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    room_of = dict(enumerate(capacities))
    for p, i in enumerate(old):
        edge(source, 1 + p, sizes[i], 0)
        for j in new:
            if i == j or (sizes[i] > room_of.get(i, 0) and sizes.get(j, 0) < room_of[j]):
                edge(1 + p, 1 + len(old) + j, sizes[i], int(i != j))
    for j in new:
        edge(1 + len(old) + j, sink, capacities[j], 0)
    left = sum(sizes.values())
    while left:
        cost, via = {source: 0}, {}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for n, (b, room, price, _) in enumerate(graph[a]):
                if room and cost[a] + price < cost.get(b, 1 << 60):
                    cost[b], via[b] = cost[a] + price, (a, n)
                    queue.append(b)
        amount, b = left, sink
        while b != source:
            a, n = via[b]
            amount, b = min(amount, graph[a][n][1]), a
        b = sink
        while b != source:
            a, n = via[b]
            graph[a][n][1] -= amount
            graph[b][graph[a][n][3]][1] += amount
            b = a
        left -= amount
    out = {}
    for p, i in enumerate(old):
        for b, room, _, _ in graph[1 + p]:
            if b > len(old) and room < sizes[i]:
                out[i, b - 1 - len(old)] = sizes[i] - room
    return out


@dataclass(frozen=True)
class Layout:
    """Shards as written: where, the columns of the documents, and rows and bytes of each old shard."""

    folder: str
    columns: list[str]
    schema: StructType
    old: dict[int, tuple[int, int]]


@dataclass(frozen=True)
class Plan:
    """Block transfers: for each old shard its ends of blocks in bytes, with the new shard of each."""

    shards: int
    cuts: dict[int, list[tuple[int, int]]]

    @property
    def rewritten(self) -> list[int]:
        """Old shards that hand rows away."""
        return sorted(i for i, own in self.cuts.items() if any(j != i for _, j in own))

    @property
    def moved_bytes(self) -> int:
        return sum(end - start for i, own in self.cuts.items() for start, (end, j) in zip([0, *(e for e, _ in own)], own) if j != i)


def lay_out(docs: DataFrame, old_shard: Column, folder: str, shards: int, text: str = "text", doc_id: str = "doc_id") -> Layout:
    """Write documents as shards (``old_shard``, a whole number), each in its fixed order.

    ``shards`` is how many there will be; it sets which groups of equal texts count as large.
    Tasks hold blocks of about ``ROWS_OF_A_BLOCK`` rows and ``BYTES_OF_A_BLOCK`` bytes at most, or
    one group of equal texts; a larger group is dealt over blocks by its ids. A null text has no
    bytes and goes with the empty ones, a null id sorts first, repeated rows are rows of their
    own, a null shard is shard 0, and an empty table gives empty shards.
    """
    spark = docs.sparkSession
    text_of = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("_wl_old"),
        text_bytes(f"`{text}`").alias("_wl_size"),
        F.xxhash64(text_of).alias("_wl_text"),
        F.xxhash64(f"`{doc_id}`").alias("_wl_id"),
    )
    groups = rows.groupBy("_wl_old", "_wl_text").agg(F.sum("_wl_size").alias("size"), F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.coalesce(F.sum("_wl_size"), F.lit(0)), F.count(F.lit(1))).first()
    # At most PARTS_OF_A_SHARD * shards groups by bytes and MOST_GROUPS by rows.
    many = max(ROWS_OF_A_BLOCK, total[1] // MOST_GROUPS)
    large = groups.filter((F.col("n") > 1) & ((F.col("size") * PARTS_OF_A_SHARD * shards > total[0]) | (F.col("n") > many))).collect()
    large.sort(key=lambda r: (-r["size"], r["_wl_old"], r["_wl_text"]))
    kinds = spark.createDataFrame([(r["_wl_old"], r["_wl_text"], n - len(large)) for n, r in enumerate(large)], "_wl_old int, _wl_text long, _wl_large int")
    rows = rows.join(F.broadcast(kinds), ["_wl_old", "_wl_text"], "left")
    rows = rows.withColumn("_wl_kind", F.coalesce("_wl_large", (63 - F.floor(F.log2("_wl_size"))).cast("int")))
    totals = rows.groupBy("_wl_old", "_wl_kind").agg(F.sum("_wl_size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    old: dict[int, tuple[int, int]] = {}
    spans, blocks_of = [], {}
    for r in sorted(totals):
        i, n_rows, n_bytes = r["_wl_old"], *old.get(r["_wl_old"], (0, 0))
        old[i] = n_rows + r["n"], n_bytes + r["size"]
        blocks = max(-(-r["n"] // ROWS_OF_A_BLOCK), -(-r["size"] // BYTES_OF_A_BLOCK))
        spans.append((i, r["_wl_kind"], blocks_of.get(i, 0), blocks))
        blocks_of[i] = blocks_of.get(i, 0) + blocks
    rows = rows.join(F.broadcast(spark.createDataFrame(spans, "_wl_old int, _wl_kind int, _wl_base int, _wl_blocks int")), ["_wl_old", "_wl_kind"])
    place = F.when(F.col("_wl_large").isNull(), F.col("_wl_text")).otherwise(F.col("_wl_id")) / F.lit(2.0**64) + 0.5
    inner = F.least(F.floor(place * F.col("_wl_blocks")), F.col("_wl_blocks") - 1)
    rows = rows.withColumn("_wl_block", (F.col("_wl_base") + inner).cast("int"))
    starts = rows.groupBy("_wl_old", "_wl_block").agg(F.sum("_wl_size").alias("size"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_wl_old").orderBy("_wl_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_wl_old", "_wl_block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_wl_first_{c}") for c in ("size", "n")))
    order = Window.partitionBy("_wl_old", "_wl_block").orderBy("_wl_text", f"`{doc_id}`", "_wl_id")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(starts, ["_wl_old", "_wl_block"]).withColumns(
        {
            "_wl_at": F.col("_wl_first_size") + F.sum("_wl_size").over(until) - F.col("_wl_size"),
            "_wl_slot": F.col("_wl_first_n") + F.row_number().over(order) - 1,
        }
    )
    group = Window.partitionBy("_wl_old", "_wl_block", "_wl_text")
    cut_at = F.when(F.col("_wl_large").isNull(), F.min("_wl_at").over(group)).otherwise(F.col("_wl_at"))
    kept = [*docs.columns, "_wl_slot", "_wl_at"]
    rows = rows.withColumn("_wl_at", cut_at).select(*(F.col(f"`{c}`") for c in kept), "_wl_old")
    rows.write.partitionBy("_wl_old").parquet(f"{folder}/old")
    return Layout(folder, docs.columns, rows.schema, old)


def plan_transfers(layout: Layout, shards: int, capacities: list[int] | None = None) -> Plan:
    """Cuts of the old shards by the cheapest flow into capacities (equal ones if none are given)."""
    sizes = {i: size for i, (_, size) in layout.old.items()}
    flows = min_cost_flow(sizes, capacities or even_capacities(sum(sizes.values()), shards))
    cuts: dict[int, list[tuple[int, int]]] = {}
    for (i, j), amount in sorted(flows.items(), key=lambda f: (f[0][0], f[0][0] != f[0][1], f[0][1])):
        own = cuts.setdefault(i, [])
        own.append(((own[-1][0] if own else 0) + amount, j))
    return Plan(shards, cuts)


def _old_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema(layout.schema).parquet(f"{layout.folder}/old")


def rewrite(spark: SparkSession, layout: Layout, plan: Plan) -> None:
    """Write the files that the transfers change: all rows of the shards that hand some away.

    Rows that move go to files of their new shard, rows that stay to a new file of theirs. No
    row crosses a shuffle: its place in the old order says where it goes.
    """
    if not plan.rewritten:
        return
    rows = _old_rows(spark, layout).filter(F.col("_wl_old").isin(plan.rewritten))
    ends = [(i, [{"until": end, "shard": j} for end, j in plan.cuts[i]]) for i in plan.rewritten]
    blocks = spark.createDataFrame(ends, "_wl_old int, _wl_ends array<struct<until:long,shard:int>>")  # one entry a transfer
    rows = rows.join(F.broadcast(blocks), "_wl_old")
    to = F.filter("_wl_ends", lambda e: F.col("_wl_at") < e["until"])[0]["shard"]
    rows.withColumn("_wl_new", to).drop("_wl_ends", "_wl_at").withColumnRenamed("_wl_old", "_wl_from").write.partitionBy("_wl_new").parquet(f"{layout.folder}/new")


def read_shards(spark: SparkSession, layout: Layout, plan: Plan) -> DataFrame:
    """The documents' columns with ``_wl_shard`` and ``_wl_slot``, gapless from 0 in every shard.

    Shards that hand nothing away are read from their old files, all else from the new ones.
    What stays keeps its slot; rows that come take the slots after, old shard by old shard.
    """
    columns = [F.col(f"`{c}`") for c in layout.columns]
    old = _old_rows(spark, layout)
    if not plan.rewritten:
        return old.select(*columns, F.col("_wl_old").alias("_wl_shard"), "_wl_slot")
    untouched = old.filter(~F.col("_wl_old").isin(plan.rewritten)).select(*columns, F.col("_wl_old").alias("_wl_shard"), "_wl_slot")
    new = spark.read.parquet(f"{layout.folder}/new").withColumn("_wl_new", F.col("_wl_new").cast("int"))
    # Rows that go from one shard to another stand side by side; one row for each transfer.
    counts = new.groupBy("_wl_new", "_wl_from").agg(F.min("_wl_slot").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    next_ = {i: rows for i, (rows, _) in layout.old.items() if i not in plan.rewritten}
    next_ |= {r["_wl_new"]: r["n"] for r in counts if r["_wl_new"] == r["_wl_from"]}
    shifts = []
    for r in sorted(counts):
        i, j = r["_wl_from"], r["_wl_new"]
        shift = 0 if i == j else next_.get(j, 0) - r["first"]
        shifts.append((j, i, shift))
        if i != j:
            next_[j] = next_.get(j, 0) + r["n"]
    moved = new.join(F.broadcast(spark.createDataFrame(shifts, "_wl_new int, _wl_from int, _wl_shift long")), ["_wl_new", "_wl_from"])
    return untouched.unionByName(moved.select(*columns, F.col("_wl_new").alias("_wl_shard"), (F.col("_wl_slot") + F.col("_wl_shift")).alias("_wl_slot")))
