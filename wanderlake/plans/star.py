"""Stored star schema: full builds and incremental runs of the GOLD tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake import schemas
from wanderlake.fixed_values import WATERMARK_DEFAULT
from wanderlake.operators.lookup import NO_HOT_KEYS, small_enough
from wanderlake.operators.upsert import compact, range_of, read_keyed, upsert, watermark
from wanderlake.plans import gold, latest_store, link_store, silver
from wanderlake.session import remove, scratch_dir
from wanderlake.sources.extract import load_state, save_state

DIMENSIONS = ("dim_customers", "dim_destinations", "dim_brokers", "dim_date")
FACTS = {"fact_policies": schemas.FACT_POLICIES, "fact_claims": schemas.FACT_CLAIMS}


def read_gold_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One stored table; a fact may still be empty, and may have more columns than at first."""
    path = f"{root}/{name}"
    if name not in FACTS:
        return spark.read.parquet(path)
    return _fact(spark, path, name)


def _fact(spark: SparkSession, path: str, name: str, ranges: DataFrame | None = None) -> DataFrame:
    stored = read_keyed(spark, path, ranges)
    if stored is None:
        return spark.createDataFrame([], schemas.ddl(FACTS[name]))
    return stored.select(*FACTS[name], *(c for c in stored.columns if c not in FACTS[name]))


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored GOLD tables."""
    return {name: read_gold_table(spark, root, name) for name in (*DIMENSIONS, *FACTS)}


def build_dimensions(
    bronze: Mapping[str, DataFrame],
    root: str,
    as_of: datetime,
    policies: DataFrame | None = None,
    customers: DataFrame | None = None,
) -> None:
    """Rebuild every dimension; ``policies`` and ``customers`` are the SILVER ones, if already there."""
    policies = silver.policies(bronze["raw_policies"]) if policies is None else policies
    customers = silver.customers(bronze["raw_customers"]) if customers is None else customers
    spark = policies.sparkSession
    tables = {
        "dim_customers": gold.dim_customers(customers, as_of),
        "dim_destinations": gold.dim_destinations(policies),
        "dim_brokers": gold.dim_brokers(silver.brokers(bronze["raw_broker_commissions"])),
        "dim_date": gold.dim_date(spark),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{root}/{name}")


def update_policies(
    raw_policies: DataFrame,
    root: str,
    lookback: timedelta = timedelta(0),
    policies: DataFrame | None = None,
    most_deltas: int = 0,
) -> None:
    """Upsert the policies created after the newest one already in the fact.

    ``lookback`` reads that much further back, for rows that arrived late. ``policies`` are the
    stored SILVER policies of this run, if there are any; they are filtered instead of being
    made again. ``most_deltas``: see ``build_star``.
    """
    spark = raw_policies.sparkSession
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in DIMENSIONS}
    by_name = {
        "customer": tables["dim_customers"],
        "destination": tables["dim_destinations"],
        "broker": tables["dim_brokers"],
    }
    small = [name for name, table in by_name.items() if small_enough(table)]
    large = [name for name in by_name if name not in small]

    def resolve(batch: DataFrame, few: bool, keys: DataFrame) -> DataFrame:
        hot = gold.policy_hot_keys(keys, large) if large and not few else NO_HOT_KEYS
        return gold.fact_policies(batch, *by_name.values(), tables["dim_date"], hot, small, few)

    def standardise(raw: DataFrame, since: datetime | None) -> DataFrame:
        return silver.policies(raw, since) if policies is None else silver.after(policies, since)

    _update(raw_policies, standardise, resolve, root, "fact_policies", "policy_id", lookback, most_deltas)


def update_claims(
    raw_claims: DataFrame,
    root: str,
    lookback: timedelta = timedelta(0),
    claims: DataFrame | None = None,
    most_deltas: int = 0,
    link_buckets: int = 0,
) -> None:
    """Upsert the claims created after the newest one already in the fact.

    A claim that comes before its policy keeps NULL keys until the claim itself is sent again.
    ``claims`` are the stored SILVER claims, if there are any. ``most_deltas`` and ``link_buckets``: see
    ``build_star``.
    """
    spark = raw_claims.sparkSession
    policies = read_gold_table(spark, root, "fact_policies")
    small = small_enough(policies)

    def resolve(batch: DataFrame, few: bool, keys: DataFrame) -> DataFrame:
        parents = policies
        if few and not small:
            # Only the ranges of the batch's policies are scanned.
            wanted = batch.select(range_of(F.col("policy_id")))
            parents = _fact(spark, f"{root}/fact_policies", "fact_policies", wanted)
        hot = NO_HOT_KEYS if small or few else gold.claim_hot_keys(keys)
        if link_buckets and not (small or few):
            links = link_store.policy_links(spark, root, link_buckets)
            if links is not None:
                return gold.fact_claims(batch, links, hot, colocated=True)
        return gold.fact_claims(batch, parents, hot, small, few)

    def standardise(raw: DataFrame, since: datetime | None) -> DataFrame:
        return silver.claims(raw, since) if claims is None else silver.after(claims, since)

    _update(raw_claims, standardise, resolve, root, "fact_claims", "claim_id", lookback, most_deltas)


def _update(
    raw: DataFrame,
    standardise: Callable[[DataFrame, datetime | None], DataFrame],
    resolve: Callable[[DataFrame, bool, DataFrame], DataFrame],
    root: str,
    name: str,
    key: str,
    lookback: timedelta,
    most_deltas: int,
) -> None:
    """Bring one fact up to date.

    An incremental batch is stored once: its size then chooses the joins, and the joins, the
    sketch and the new mark read it instead of repeating the deduplication. A first load is
    as large as the fact and goes straight through; its keys are looked at in BRONZE. The
    mark is noted after the upsert, so a run that was cut short is repeated in full.
    """
    spark = raw.sparkSession
    path, marks = f"{root}/{name}", f"{root}/marks"
    since = _newest(spark, path, marks, name)
    if since is None:
        upsert(resolve(standardise(raw, None), False, raw), path, key, known_unique=True)
        mark = watermark(read_gold_table(spark, root, name), "created_at", WATERMARK_DEFAULT)
    else:
        staging = scratch_dir(spark, name)
        standardise(raw, since - lookback).write.parquet(staging)
        batch = spark.read.parquet(staging)
        rows = resolve(batch, small_enough(batch), batch)
        upsert(rows, path, key, known_unique=True, deltas=most_deltas > 0)
        compact(spark, path, most_deltas)
        mark = max(since, watermark(batch, "created_at", WATERMARK_DEFAULT))
        remove(spark, staging)
    save_state(spark, marks, {name: mark})


def _newest(spark: SparkSession, path: str, marks: str, name: str) -> datetime | None:
    """Creation time of the fact's newest row; None before its first rows.

    Normally it was noted by the last run. Without a note the fact is asked: it appears whole
    or not at all, so the run that wrote it had only its note left to write.
    """
    stored = read_keyed(spark, path)
    if stored is None:
        return None
    noted = load_state(spark, marks).get(name)
    return noted or watermark(stored, "created_at", WATERMARK_DEFAULT)


def build_star(
    bronze: Mapping[str, DataFrame],
    root: str,
    as_of: datetime,
    loads: Mapping[str, str] | None = None,
    most_deltas: int = 0,
    link_buckets: int = 0,
) -> None:
    """One GOLD run: dimensions in full, facts as far as they are new.

    ``loads`` names the folders of loads of customers, policies and claims. Then their latest
    rows are stored (``latest_store``), a run reads only the loads that came since the last
    one, and everything else reads the stored rows. Without it SILVER policies are made from all
    RAW rows and stored once for this run; the destinations and the fact both read them.

    With ``most_deltas`` a run writes its batch as deltas over the fact, and rewrites only ranges
    that have gathered more than so many. That suits batches scattered over the whole fact; serial
    keys, whose batches land in few ranges, read faster without.

    With ``link_buckets`` claims in large batches find their policies in a narrow copy that is
    bucketed by ``policy_id`` (``link_store``), so only the claims are shuffled. That pays if large
    batches come again and again, as after corrections of a source.
    """
    spark = bronze["raw_broker_commissions"].sparkSession
    if loads:
        for name in latest_store.KEYS:
            latest_store.refresh(spark, loads[name], root, name)
        raw = {name: latest_store.latest(spark, root, name) for name in latest_store.KEYS}
        missing = [name for name, rows in raw.items() if rows is None]
        if missing:
            raise ValueError(f"no loads of {', '.join(missing)}")
        ready = {name: latest_store.STANDARD[name](rows) for name, rows in raw.items()}
        build_dimensions(bronze, root, as_of, ready["raw_policies"], ready["raw_customers"])
        update_policies(raw["raw_policies"], root, policies=ready["raw_policies"], most_deltas=most_deltas)
        update_claims(raw["raw_claims"], root, claims=ready["raw_claims"], most_deltas=most_deltas, link_buckets=link_buckets)
        return
    build_policies(bronze, root, as_of, most_deltas)
    update_claims(bronze["raw_claims"], root, most_deltas=most_deltas, link_buckets=link_buckets)


def build_policies(bronze: Mapping[str, DataFrame], root: str, as_of: datetime, most_deltas: int = 0) -> None:
    """The part of a GOLD run over RAW rows that comes before the claims: dimensions and policies."""
    spark = bronze["raw_policies"].sparkSession
    staging = scratch_dir(spark, "silver-policies")
    silver.policies(bronze["raw_policies"]).write.parquet(staging)
    policies = spark.read.parquet(staging)
    build_dimensions(bronze, root, as_of, policies)
    update_policies(bronze["raw_policies"], root, policies=policies, most_deltas=most_deltas)
    remove(spark, staging)
