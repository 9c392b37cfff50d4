"""Business reports over the stored facts from sums that are kept for every key range.

A fact consists of key ranges, and its manifest names the files of each. The rows of a range are
summed into cells (one for each combination of the columns that reports group by) and the cells
are stored under the range's state, as the checks of ``check_store`` are. A report reads the
cells of the states that the manifest names now. A range that was rewritten, got a delta or was
compacted has a new state: its rows are summed again and its old cells no longer count, so a row
that moves from one group to another leaves the first and enters the second.

Only additive numbers are kept (sums and counts); ratios and averages are taken from the totals.
A range has no more cells than rows, and usually some thousands for a million rows. All cells are
stored anew, under the next number, by a report that sums something; a folder counts once Spark
has marked it as complete. Cells of another definition have another folder.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.functions.times import month_start
from wanderlake.operators.upsert import Manifest, read_manifest, state_of
from wanderlake.plans import metrics, star
from wanderlake.plans.check_store import STATE, rows_by_state
from wanderlake.session import children, remove


class Cells(NamedTuple):
    """What to group a fact by, and the additive aggregates of each group."""

    groups: dict[str, Column]
    sums: dict[str, Column]

    def of(self, rows: DataFrame) -> DataFrame:
        named = [c.alias(name) for name, c in self.groups.items()]
        state = [STATE] if STATE in rows.columns else []
        return rows.groupBy(*state, *named).agg(*[c.alias(name) for name, c in self.sums.items()])

    def digest(self) -> str:
        text = repr([[(name, str(c)) for name, c in part.items()] for part in self])
        return hashlib.sha256(text.encode()).hexdigest()[:16]


def policy_cells() -> Cells:
    return Cells(
        {"month": month_start(F.col("trip_start_date")), "destination_sk": F.col("destination_sk")},
        {"premium": F.sum("premium_amount"), "policies": F.count(F.lit(1))},
    )


def claim_cells() -> Cells:
    return Cells(
        {name: F.col(name) for name in ("claim_type", "claim_status", "destination_sk")},
        {
            "claims": F.count(F.lit(1)),
            "approved": F.sum(F.when(F.col("is_approved"), 1).otherwise(0)),
            "amount": F.sum("claim_amount"),
            "amounts": F.count("claim_amount"),
        },
    )


CELLS = {"fact_policies": policy_cells, "fact_claims": claim_cells}


def current_cells(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Cells of a stored fact as it is now, one set for each key range; none of an empty fact.

    Ranges whose state is not stored are scanned first, in the columns that the cells need.
    """
    wanted = CELLS[name]()
    path, store = f"{root}/{name}", f"{root}/cells/{name}-{wanted.digest()}"
    _, entries = read_manifest(spark, path)
    if not entries:
        return wanted.of(star.read_gold_table(spark, root, name))
    states = {state_of(r, e): r for r, e in entries.items()}
    current = F.broadcast(spark.createDataFrame([(s,) for s in states], f"{STATE} string"))
    stored = _stored(spark, store)
    # At most one row for each range of the manifest.
    known = {r[STATE] for r in stored.select(STATE).distinct().join(current, STATE, "left_semi").collect()} if stored is not None else set()
    fresh: Manifest = {r: entries[r] for s, r in states.items() if s not in known}
    if fresh:
        summed = wanted.of(rows_by_state(spark, path, fresh))
        kept = stored.join(current, STATE, "left_semi").unionByName(summed) if stored is not None else summed
        _store(spark, store, kept)
        stored = _stored(spark, store)
    return stored.join(current, STATE, "left_semi").drop(STATE)


def revenue_by_month(spark: SparkSession, root: str) -> DataFrame:
    cells = current_cells(spark, root, "fact_policies")
    return cells.groupBy("month").agg(_total(cells, "premium", "total_premium"), _total(cells, "policies", "policy_count")).orderBy("month")


def premium_by_destination(spark: SparkSession, root: str) -> DataFrame:
    cells = current_cells(spark, root, "fact_policies")
    per_key = cells.groupBy("destination_sk").agg(_total(cells, "premium", "premium"))
    return metrics.premiums_labelled(per_key, star.read_gold_table(spark, root, "dim_destinations"))


def revenue_kpis(spark: SparkSession, root: str, as_of: datetime) -> DataFrame:
    return metrics.revenue_kpis(revenue_by_month(spark, root), as_of)


def claim_kpis(spark: SparkSession, root: str) -> DataFrame:
    cells = current_cells(spark, root, "fact_claims")
    counted = cells.agg(F.coalesce(F.sum("claims"), F.lit(0)).alias("total_claims"), F.sum("approved").alias("approved_claims"))
    return metrics.approval_rate(counted)


def claims_by_type(spark: SparkSession, root: str) -> DataFrame:
    counted = current_cells(spark, root, "fact_claims").groupBy("claim_type").agg(F.sum("claims").alias("claim_count"))
    return counted.orderBy(F.desc_nulls_first("claim_count"), "claim_type")


def average_claim_by_destination(spark: SparkSession, root: str) -> DataFrame:
    cells = current_cells(spark, root, "fact_claims")
    per_key = cells.groupBy("destination_sk").agg(_total(cells, "amount", "amount"), _total(cells, "amounts", "claims"))
    return metrics.averages_labelled(per_key, star.read_gold_table(spark, root, "dim_destinations"))


def approval_by_type(spark: SparkSession, root: str) -> DataFrame:
    decided = current_cells(spark, root, "fact_claims").filter(F.col("claim_status").isin("approved", "rejected"))
    return decided.groupBy("claim_type", "claim_status").agg(F.sum("claims").alias("claim_count")).orderBy("claim_type", "claim_status")


def _total(cells: DataFrame, column: str, name: str) -> Column:
    """Sum of a cell column in the type of the cells, which is that of the sum over the rows."""
    return F.sum(column).cast(cells.schema[column].dataType).alias(name)


def _complete(spark: SparkSession, store: str) -> list[str]:
    """Stored runs, oldest first; one that was cut short is left out."""
    runs = sorted(n for n in children(spark, store) if n.startswith("run-"))
    return [n for n in runs if "_SUCCESS" in children(spark, f"{store}/{n}")]


def _stored(spark: SparkSession, store: str) -> DataFrame | None:
    runs = _complete(spark, store)
    return spark.read.parquet(f"{store}/{runs[-1]}") if runs else None


def _store(spark: SparkSession, store: str, cells: DataFrame) -> None:
    """Write all current cells as the next run; the run before stays for those who read it."""
    runs = _complete(spark, store)
    number = int(runs[-1].split("-")[1]) + 1 if runs else 1
    cells.write.parquet(f"{store}/run-{number:09d}-{uuid.uuid4().hex}")
    for name in runs[:-1]:
        remove(spark, f"{store}/{name}")
