"""Source against target: row counts, and where two tables differ.

Equal counts do not mean equal tables. ``differing_ranges`` compares checksums of key ranges that
do not depend on the order of rows, first of wide ranges, then of narrower ones within those that
differ; ``differing_rows`` names the rows in the narrowest ones. Each level adds up both tables in
one aggregate with opposite signs, so nothing is joined, a range becomes one row in every input
task before the shuffle, and only ranges that differ are read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderlake.fixed_values import RECONCILE_THRESHOLD
from wanderlake.session import scratch_dir
from wanderlake.sources.tables import row_counts

SPANS = (1_000_000, 1_000)
_SIDE = "__side"
_RANGE = "__range"


def match_percentage(source: Column, target: Column) -> Column:
    """100 for equal counts, falling with the difference and not below zero."""
    off = F.try_divide(F.abs(source - target).cast("double"), source.cast("double"))
    empty = F.when(target == 0, F.lit(100.0)).otherwise(F.lit(0.0))
    return F.when(source == 0, empty).otherwise(F.greatest(F.lit(0.0), (1 - off) * 100))


def compare_counts(counts: DataFrame, threshold: float = RECONCILE_THRESHOLD) -> DataFrame:
    """Adds difference, match percentage and verdict to (source_count, destination_count)."""
    source, target = F.col("source_count"), F.col("destination_count")
    rounded = F.round(match_percentage(source, target), 2)
    return counts.withColumns(
        {
            "difference": target - source,
            "match_percentage": rounded,
            "passed": rounded >= threshold,
        }
    )


def reconcile(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], threshold: float = RECONCILE_THRESHOLD
) -> DataFrame:
    """One row per source table and its GOLD counterpart."""
    sources = row_counts({name: source for name, (source, _) in pairs.items()})
    targets = row_counts({name: target for name, (_, target) in pairs.items()})
    counts = sources.withColumnRenamed("row_count", "source_count").join(
        targets.withColumnRenamed("row_count", "destination_count"), "table_name"
    )
    return compare_counts(counts, threshold)


def verdict(report: DataFrame) -> DataFrame:
    """True when every table passed."""
    return report.agg(F.bool_and("passed").alias("all_passed"))


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def differing_ranges(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, spans: Sequence[int] = SPANS
) -> DataFrame:
    """Key ranges of the last of ``spans`` whose rows differ, with the rows of both tables in them.

    ``key`` is an integer column; rows without a key are a range of their own, with NULL bounds.
    ``columns`` (all that both tables have) are compared together with the key, in a type that
    holds both; NULL equals NULL, and a row that is there twice differs from one that is there
    once. Every span is narrower than the one before. Two sums of 64-bit hashes and both counts
    would have to agree by chance for a difference to go unseen. Two empty tables do not differ.
    """
    both, rows = _both(source, target, key, columns), None
    for span in spans:
        rows = both if rows is None else _within(both, rows, key)
        rows = _stage(_sums(rows, key, span), span)
    first = F.col(_RANGE) * spans[-1]
    return rows.select(
        first.alias("range_start"), (first + spans[-1]).alias("range_end"), "source_rows", "target_rows"
    )


def differing_rows(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, spans: Sequence[int] = SPANS
) -> DataFrame:
    """One row for each key whose rows differ: which of them only one table has, and in what.

    ``status`` is ``missing`` (only the source has rows of the key that differ), ``unexpected``
    (only the target) or ``changed``; the two counts are of differing rows alone. For a changed
    key ``differing_columns`` are those whose smallest or largest value differs between the
    tables, which for unique keys means their value. Arguments: see ``differing_ranges``.
    """
    both = _both(source, target, key, columns)
    found = differing_ranges(source, target, key, columns, spans)
    ranges = found.select((F.col("range_start") / spans[-1]).cast("bigint").alias(_RANGE), F.lit(spans[-1]).alias("span"))
    compared = [c for c in both.columns if c not in (key, _SIDE)]
    counted = _within(both, ranges, key).groupBy(key, *compared).agg(_rows_of(1, "source_rows"), _rows_of(-1, "target_rows"))
    left = counted.filter("source_rows <> target_rows").withColumns(
        {
            "source_rows": F.greatest(F.col("source_rows") - F.col("target_rows"), F.lit(0)),
            "target_rows": F.greatest(F.col("target_rows") - F.col("source_rows"), F.lit(0)),
        }
    )
    ours, theirs = F.col("source_rows") > 0, F.col("target_rows") > 0
    differs = {c: ~_ends(c, ours).eqNullSafe(_ends(c, theirs)) for c in compared}
    names = [F.when(differs[c], F.lit(c)) for c in compared] or [F.lit(None).cast("string")]
    per_key = left.groupBy(key).agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"), F.array_compact(F.array(*names)).alias("differing_columns")
    )
    changed = ours & theirs
    return per_key.select(
        key,
        F.when(changed, "changed").when(ours, "missing").otherwise("unexpected").alias("status"),
        "source_rows",
        "target_rows",
        F.when(changed, F.col("differing_columns")).otherwise(F.array().cast("array<string>")).alias("differing_columns"),
    )


def _both(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None) -> DataFrame:
    """Rows of both tables, those of the source with side 1 and those of the target with -1."""
    names = [c for c in (source.columns if columns is None else columns) if c != key and c in target.columns]
    return (
        source.select(key, *names, F.lit(1).alias(_SIDE))
        .unionByName(target.select(key, *names, F.lit(-1).alias(_SIDE)))
    )


def _rows_of(side: int, name: str) -> Column:
    return F.count_if(F.col(_SIDE) == side).alias(name)


def _sums(both: DataFrame, key: str, span: int) -> DataFrame:
    """Ranges whose counts or sums of hashes do not cancel out."""
    compared = [F.col(c) for c in both.columns if c != _SIDE]
    # A hash passes over NULLs, so it also takes which columns are NULL.
    compared += [c.isNull() for c in compared]
    signed = [F.xxhash64(F.lit(seed), *compared).cast("decimal(20,0)") * F.col(_SIDE) for seed in (0, 1)]
    sums = both.groupBy(F.floor(F.col(key) / span).cast("bigint").alias(_RANGE)).agg(
        _rows_of(1, "source_rows"), _rows_of(-1, "target_rows"), *[F.sum(h).alias(f"__sum{i}") for i, h in enumerate(signed)]
    )
    return sums.filter("source_rows <> target_rows OR __sum0 <> 0 OR __sum1 <> 0")


def _stage(ranges: DataFrame, span: int) -> DataFrame:
    path = scratch_dir(ranges.sparkSession, "differing-ranges")
    ranges.select(_RANGE, F.lit(span).alias("span"), "source_rows", "target_rows").write.parquet(path)
    return ranges.sparkSession.read.parquet(path)


def _within(both: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Rows of the given ranges; their outer bounds are literals, which scans use to skip files."""
    row = ranges.agg(
        F.min(_RANGE).alias("first"), F.max(_RANGE).alias("last"), F.max("span").alias("span"), F.count_if(F.col(_RANGE).isNull()).alias("nulls")
    ).first()
    if row["first"] is None:
        return both.filter(F.col(key).isNull() if row["nulls"] else F.lit(False))
    inside = (F.col(key) >= row["first"] * row["span"]) & (F.col(key) < (row["last"] + 1) * row["span"])
    near = both.filter(inside | F.col(key).isNull() if row["nulls"] else inside)
    wanted = ranges.select(F.col(_RANGE).alias("__wanted"))
    return near.join(wanted, F.floor(F.col(key) / row["span"]).cast("bigint").eqNullSafe(F.col("__wanted")), "left_semi")


def _ends(column: str, side: Column) -> Column:
    value = F.when(side, F.col(column))
    return F.struct(F.min(value), F.max(value))
