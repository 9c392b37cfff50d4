"""Left lookups into tables with one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderlake.functions.text import keys_packed, keys_unpacked, surrogate_columns

# Rows of a key and one or two short columns: some tens of megabytes.
BROADCAST_ROWS = 250_000


@dataclass(frozen=True)
class HotKeys:
    """Key values that each fill more than their share of a table, and how far to spread them."""

    values: dict[str, list] = field(default_factory=dict)
    nulls: frozenset[str] = frozenset()
    spread: int = 1

    def of(self, name: str) -> list:
        return self.values.get(name, [])


NO_HOT_KEYS = HotKeys()


def find_hot_keys(df: DataFrame, keys: dict[str, Column], share: float = 0.005) -> HotKeys:
    """Find the keys that would overload one shuffle partition.

    One narrow scan feeds a frequent-items sketch per key; the result is a single row with
    at most 1/share values per key, whatever the size of the table. The sketch only decides
    which keys are spread out in a join, never which rows it returns.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(share, min(0.25, 2.0 / partitions))
    listed = int(1 / share) + 1
    tracked = max(10_000, 20 * listed)
    narrow = df.select(*[expression.alias(name) for name, expression in keys.items()])
    sketches = [
        F.call_function(
            "approx_top_k", F.col(name), F.lit(listed), F.lit(tracked)
        ).alias(name)
        for name in keys
    ]
    row = narrow.agg(F.count(F.lit(1)).alias("__rows"), *sketches).first()
    limit = row["__rows"] * share
    values, nulls = {}, set()
    for name in keys:
        hot = [entry["item"] for entry in row[name] or [] if entry["count"] > limit]
        if None in hot:
            nulls.add(name)
        values[name] = [item for item in hot if item is not None]
    return HotKeys(values, frozenset(nulls), partitions)


def small_enough(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table of short rows may be broadcast; counted from its footers."""
    return table.count() <= rows


def lookup(
    facts: DataFrame,
    table: DataFrame,
    fact_key: Column,
    table_key: str,
    name: str = "",
    hot: HotKeys = NO_HOT_KEYS,
    salt_by: Sequence[str] = (),
    small: bool = False,
    few_facts: bool = False,
    colocated: bool = False,
) -> DataFrame:
    """Left join to a table that holds each key once; a NULL key never matches.

    Checked sizes choose the plan. A ``small`` table is broadcast. For ``few_facts`` the
    table is first cut down to the facts' keys without moving it, which leaves at most one
    row per fact to broadcast. Otherwise Catalyst chooses by the size it knows, and if it
    shuffles, hot fact keys (and NULLs, when they are many) are spread over ``hot.spread``
    partitions by a hash of ``salt_by``, while the table repeats the rows of those few keys
    once per salt.

    A ``colocated`` table is bucketed by its key and stays where it is: facts without a key are
    spread, and so are those of hot keys, whose few rows of the table are broadcast.
    """
    kept = [c for c in table.columns if c != table_key]
    right = table.select(F.col(table_key).alias("__key"), *kept)
    left = facts.withColumn("__fact_key", fact_key)
    match = F.col("__fact_key") == F.col("__key")
    values = hot.of(name)
    # A table that may be shuffled moves its surrogate keys as bytes.
    packed = [] if small or few_facts or colocated else [c for c in surrogate_columns(right) if c in kept]
    if packed:
        right = keys_packed(right, packed)
    if small:
        right = F.broadcast(right)
    elif few_facts:
        wanted = left.select(F.col("__fact_key").alias("__wanted")).distinct()
        right = right.join(F.broadcast(wanted), F.col("__key") == F.col("__wanted"), "left_semi")
        right = F.broadcast(right)
    elif colocated:
        return _beside(left, right, kept, values, salt_by)
    elif values or name in hot.nulls:
        spread = F.pmod(F.xxhash64(*salt_by), F.lit(hot.spread)).cast("int")
        is_hot = F.lit(False)
        salts = F.array(F.lit(0))
        if values:
            is_hot = F.coalesce(F.col("__fact_key").isin(values), F.lit(False))
            every_salt = F.sequence(F.lit(0), F.lit(hot.spread - 1))
            salts = F.when(F.col("__key").isin(values), every_salt).otherwise(salts)
        right = right.withColumn("__table_salt", F.explode(salts))
        left = left.withColumn(
            "__salt", F.when(is_hot | F.col("__fact_key").isNull(), spread).otherwise(F.lit(0))
        )
        match = match & (F.col("__salt") == F.col("__table_salt"))
    joined = left.join(right, match, "left")
    if packed:
        joined = keys_unpacked(joined, packed)
    return joined.drop("__fact_key", "__key", "__salt", "__table_salt")


def _beside(left: DataFrame, right: DataFrame, kept: Sequence[str], values: list, salt_by: Sequence[str]) -> DataFrame:
    """Join facts to a table bucketed by ``__key`` in one shuffle of the facts alone."""
    key = F.col("__fact_key")
    is_hot = F.coalesce(key.isin(values), F.lit(False)) if values else F.lit(False)
    apart = is_hot | key.isNull()
    # Facts set apart go anywhere; should that place be another key's, the last condition holds.
    spread = F.xxhash64(*salt_by).cast(left.schema["__fact_key"].dataType)
    moved = left.withColumns({"__place": F.when(apart, spread).otherwise(key), "__apart": apart})
    joined = moved.join(right, (F.col("__place") == F.col("__key")) & ~F.col("__apart"), "left")
    if values:
        # At most one row for each hot key, of which there are no more than a sketch lists.
        few = right.filter(F.col("__key").isin(values)).select(F.col("__key").alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in kept])
        joined = joined.join(F.broadcast(few), key == F.col("__hot"), "left")
        joined = joined.withColumns({c: F.when(F.col("__apart"), F.col(f"__hot_{c}")).otherwise(F.col(c)) for c in kept})
    return joined.drop("__fact_key", "__key", "__place", "__apart", "__hot", *[f"__hot_{c}" for c in kept])


def missing_parents(
    children: DataFrame, child_key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Non-null child keys without a parent, with their row counts.

    Both sides are reduced to one row per key first, so a key shared by many rows crosses
    the shuffle once per input task and joins as a single row.
    """
    counted = (
        children.filter(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parents.select(F.col(parent_key).alias("__parent")).distinct()
    return counted.join(known, F.col(child_key) == F.col("__parent"), "left_anti")
