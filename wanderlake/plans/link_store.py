"""What claims inherit from their policy, kept co-located by policy.

``fact_policies`` is stored in ranges of its key, which Spark cannot join without a shuffle. Of
the columns that claims inherit there is a second, narrow copy, bucketed by ``policy_id``. It is
brought up to date from the fact's manifest: only ranges whose state is not covered yet are read,
and of a range that got deltas since only these; their rows lie on top of older ones. An upsert never
removes a key, so that gives the same rows as the fact. Large batches of claims then move to the policies, which stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wanderlake.operators import colocated
from wanderlake.operators.upsert import Layers, read_manifest, read_ranges, state_of
from wanderlake.plans.gold import INHERITED

KEY = "policy_id"


def policy_links(spark: SparkSession, root: str, buckets: int) -> DataFrame | None:
    """Key and inherited columns of all stored policies, bucketed by key; None of an empty fact.

    The first call copies the whole fact and fixes ``buckets``; later ones copy the ranges that
    were rewritten or got deltas since. Two calls at once may copy a range twice, which changes nothing.
    """
    path = f"{root}/links/fact_policies"
    _, entries = read_manifest(spark, f"{root}/fact_policies")
    states = {state_of(r, e): r for r, e in entries.items() if r is not None}
    _, links = colocated.read_links(spark, path)
    covers = links.covers if links else frozenset()
    fresh = {r: _uncovered(r, entries[r], covers) for s, r in states.items() if s not in covers}
    if fresh:
        rows = read_ranges(spark, f"{root}/fact_policies", fresh).select(KEY, *INHERITED)
        colocated.append(rows, path, KEY, links.buckets if links else buckets, states)
        colocated.compact(spark, path)
    return colocated.read(spark, path)


def _uncovered(key_range: int, entry: str | Layers, covers: frozenset[str]) -> str | Layers:
    """The layers of a range above those that are covered; all of them if none are."""
    if isinstance(entry, Layers):
        for count in reversed(range(len(entry.deltas))):
            if state_of(key_range, entry._replace(deltas=entry.deltas[:count])) in covers:
                (_, first), *rest = entry.deltas[count:]
                return entry._replace(base=first, deltas=tuple(rest)) if rest else first
    return entry
