"""Every job and report as a query over the given tables.

Each query reads whole tables. Reports run on a star schema that is built by the same GOLD
jobs a deployment runs, once per session and input folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake import schemas
from wanderlake.functions import numbers, times
from wanderlake.functions.text import trim_strings
from wanderlake.operators.lookup import NO_HOT_KEYS, missing_parents, small_enough
from wanderlake.operators.upsert import compact, read_keyed
from wanderlake.plans import bronze, check_store, daily, gold, latest_store, link_store, metrics, monitor, quality, reconcile, report_store, result_store, silver, star
from wanderlake.session import scratch_dir
from wanderlake.sources import broker_files, extract, fixtures, messages, tables
from wanderlake.streaming import flights as flight_stream
from wanderlake.streaming import policies as policy_stream
from wanderlake.streaming import topics

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2025, 6, 30, 12)  # reports and ages
EVENTS_AS_OF = datetime(2029, 7, 30, 0, 30)  # shortly before the newest policies
LANDING_AS_OF = datetime(2024, 1, 30, 23, 59)  # shortly after the newest flights
CUT = datetime(2026, 1, 1)  # first and second run of incremental jobs
PUBLISHED_CUT = datetime(2029, 1, 30)
LANDED_CUT = datetime(2024, 1, 15, 12)
PURCHASE_FILES = (datetime(1990, 1, 1), datetime(2025, 1, 1), datetime(2027, 6, 1), datetime(2099, 1, 1))
LINK_BUCKETS = 16
STREAM_DELAY = "1 hour"

_star_roots: dict[tuple[str, str], str] = {}
_claims_built: set[tuple[str, str]] = set()
_summed_roots: dict[tuple[str, str], str] = {}
_daily_roots: dict[tuple[str, str], str] = {}


def bronze_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "raw_customers": fixtures.raw_customers(spark, sf),
        "raw_policies": fixtures.raw_policies(spark, sf),
        "raw_claims": fixtures.raw_claims(spark, sf),
        "raw_broker_commissions": fixtures.raw_brokers(spark, sf),
    }


def star_root(spark: SparkSession, sf: str, names: Sequence[str] = tuple(star.FACTS)) -> str:
    """Folder of the GOLD tables for an input folder, built on first use in a session.

    The claims, which are the last step of a GOLD run, are built on first use of their own.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _star_roots:
        root = scratch_dir(spark, "star")
        star.build_policies(bronze_tables(spark, sf), root, AS_OF)
        _star_roots[key] = root
    if "fact_claims" in names and key not in _claims_built:
        star.update_claims(fixtures.raw_claims(spark, sf), _star_roots[key])
        _claims_built.add(key)
    return _star_roots[key]


def stored(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return star.read_gold_table(spark, star_root(spark, sf, [name]), name)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Nine decimals for averages of floating-point values, whose last bits depend on order."""
    return df.withColumns({name: F.round(name, 9) for name in names})


# --- BRONZE ---------------------------------------------------------------------------


def clean_flights_30s(spark, sf):
    return bronze.clean_flights(fixtures.raw_flights(spark, sf), LANDING_AS_OF)


def clean_flights_1h(spark, sf):
    return bronze.clean_flights(fixtures.raw_flights(spark, sf), LANDING_AS_OF, seconds=3600)


def clean_policies(spark, sf):
    return bronze.clean_policies(fixtures.raw_policies(spark, sf))


def flight_daily_stats(spark, sf):
    stats = bronze.flight_daily_stats(clean_flights_30s(spark, sf))
    return rounded(stats, "avg_altitude", "avg_velocity", "pct_on_ground")


def flight_daily_report(spark, sf):
    return bronze.flight_daily_report(flight_daily_stats(spark, sf))


def cleaning_removed_rows(spark, sf):
    raw_flights = fixtures.raw_flights(spark, sf)
    raw_policies = fixtures.raw_policies(spark, sf)
    return bronze.removal_report(
        {
            "RAW_FLIGHTS": (raw_flights, bronze.clean_flights(raw_flights, LANDING_AS_OF)),
            "RAW_POLICIES": (raw_policies, bronze.clean_policies(raw_policies)),
        }
    )


def trimmed_claims(spark, sf):
    return trim_strings(fixtures.raw_claims(spark, sf))


def event_buckets(spark, sf):
    """Events per 30-second bucket."""
    start = times.bucket_start(F.col("event_timestamp"), 30).alias("bucket_start")
    return fixtures.raw_flights(spark, sf).groupBy(start).agg(F.count(F.lit(1)).alias("event_count"))


def bronze_row_counts(spark, sf):
    raw = bronze_tables(spark, sf)
    raw_flights = fixtures.raw_flights(spark, sf)
    clean = bronze.clean_flights(raw_flights, LANDING_AS_OF)
    return tables.row_counts(
        {
            "RAW_CUSTOMERS": raw["raw_customers"],
            "RAW_POLICIES": raw["raw_policies"],
            "RAW_CLAIMS": raw["raw_claims"],
            "RAW_BROKER_COMMISSIONS": raw["raw_broker_commissions"],
            "RAW_FLIGHTS": raw_flights,
            "BRONZE_FLIGHTS_CLEAN": clean,
            "BRONZE_POLICIES_CLEAN": bronze.clean_policies(raw["raw_policies"]),
            "FLIGHT_DAILY_STATS": bronze.flight_daily_stats(clean),
        }
    )


# --- ingest ---------------------------------------------------------------------------


def incremental_extract(spark, sf):
    return extract.extract(fixtures.raw_policies(spark, sf), CUT)


def extract_run(spark, sf):
    """Two extract runs over growing sources; the summary of the second."""
    root = scratch_dir(spark, "extract")
    sources = {
        "customers": fixtures.raw_customers(spark, sf),
        "policies": fixtures.raw_policies(spark, sf),
        "claims": fixtures.raw_claims(spark, sf),
    }
    before = {name: df.filter(F.col("created_at") <= times.moment(CUT)) for name, df in sources.items()}
    extract.run_extract(before, f"{root}/bronze", f"{root}/state", CUT)
    return extract.run_extract(sources, f"{root}/bronze", f"{root}/state", EVENTS_AS_OF)


def appended_customers(spark, sf):
    """RAW_CUSTOMERS as stored by an append load, under upper-case names."""
    path = scratch_dir(spark, "append")
    tables.append_load(fixtures.raw_customers(spark, sf), path, "first")
    return tables.read_loads(spark, path)


def newest_broker_drop(spark, sf):
    """Two daily drops are written; the newer one, with its columns turned, is found and loaded."""
    root = scratch_dir(spark, "drops")
    raw = fixtures.raw_brokers(spark, sf)
    for day, step in (("2024-01-01", 1), ("2024-01-02", -1)):
        one_day = raw.filter(F.col("report_date") == F.lit(day).cast("date"))
        broker_files.write_drop(one_day, f"{root}/in", day, list(schemas.RAW_BROKER_COMMISSIONS)[::step])
    broker_files.load_newest_drop(spark, f"{root}/in", f"{root}/bronze")
    return daily.lower_names(tables.read_loads(spark, f"{root}/bronze"))


def flight_messages_accepted(spark, sf):
    decoded = messages.decode_flights(
        fixtures.flight_messages(spark, sf), times.moment(LANDING_AS_OF)
    )
    return messages.accepted_flights(decoded)


def flight_messages_rejected(spark, sf):
    return messages.rejected_messages(messages.decode_flights(fixtures.flight_messages(spark, sf)))


def flight_states(spark, sf):
    states = messages.flight_states(fixtures.api_responses(spark, sf))
    return messages.normalise_states(states, LANDING_AS_OF)


def flight_state_messages(spark, sf):
    return flight_stream.state_messages(fixtures.api_responses(spark, sf), LANDING_AS_OF)


def recent_policies(spark, sf):
    return policy_stream.recent_policies(fixtures.raw_policies(spark, sf), EVENTS_AS_OF)


def policy_events(spark, sf):
    """Messages of the recent policies that are not in the sent log."""
    recent = recent_policies(spark, sf)
    sent = recent.filter(F.col("policy_id") % 3 == 0).select("policy_id")
    due, _ = policy_stream.due_policies(recent, sent)
    return policy_stream.policy_messages(due, EVENTS_AS_OF)


def published_policies(spark, sf):
    """Three publishing runs over a year of policies: how often each one was sent.

    The first sees a part, the second the rest; by the third all were sent, so all are due again.
    """
    root, hours = scratch_dir(spark, "published"), 24 * 365
    raw = fixtures.raw_policies(spark, sf)
    early = raw.filter(F.col("created_at") <= times.moment(PUBLISHED_CUT))
    for policies in (early, raw, raw):
        policy_stream.publish_due(policies, EVENTS_AS_OF, f"{root}/topic", f"{root}/sent", hours)
    sent = spark.read.schema("key string, value string").json(f"{root}/topic")
    return sent.groupBy("key").agg(F.count(F.lit(1)).alias("messages"))


def refreshed_flights(spark, sf):
    """Clean flights after two landings: days of the second have its stamp, the others the first's."""
    root = scratch_dir(spark, "refreshed")
    raw = fixtures.raw_flights(spark, sf)
    first = raw.filter(F.col("ingested_at") <= times.moment(LANDED_CUT))
    bronze.refresh_flights(first, root, LANDED_CUT)
    bronze.refresh_flights(raw, root, LANDING_AS_OF)
    return bronze.read_clean_flights(raw, root)


# --- SILVER ---------------------------------------------------------------------------


def stg_customers(spark, sf):
    return silver.customers(fixtures.raw_customers(spark, sf))


def stg_policies(spark, sf):
    return silver.policies(fixtures.raw_policies(spark, sf))


def stg_claims(spark, sf):
    return silver.claims(fixtures.raw_claims(spark, sf))


def stg_brokers(spark, sf):
    return silver.brokers(fixtures.raw_brokers(spark, sf))


def stg_flights(spark, sf):
    return silver.flights(clean_flights_30s(spark, sf))


def stg_flight_stats(spark, sf):
    return silver.flight_stats(flight_daily_stats(spark, sf))


def silver_incremental(spark, sf, name):
    """SILVER form of a stored latest-row table that was fed load by load.

    The last load repeats the newest rows of the ones before, as a run that overlaps another does.
    """
    root = scratch_dir(spark, "latest")
    raw = bronze_tables(spark, sf)[name]
    created = F.col("created_at")
    first = raw.filter(created <= times.moment(CUT))
    rest = raw.filter((created > times.moment(CUT - timedelta(days=90))) | created.isNull())
    for number, load in enumerate((first, rest)):
        tables.append_load(load, f"{root}/loads", str(number))
        latest_store.refresh(spark, f"{root}/loads", root, name, keys_per_range=10_000)
    return latest_store.standardised(spark, root, name)


def silver_policies_incremental(spark, sf):
    return silver_incremental(spark, sf, "raw_policies")


def silver_claims_incremental(spark, sf):
    return silver_incremental(spark, sf, "raw_claims")


def silver_customers_incremental(spark, sf):
    return silver_incremental(spark, sf, "raw_customers")


# --- GOLD -----------------------------------------------------------------------------


def dim_customers(spark, sf):
    return gold.dim_customers(stg_customers(spark, sf), AS_OF)


def dim_destinations(spark, sf):
    return gold.dim_destinations(stg_policies(spark, sf))


def dim_brokers(spark, sf):
    return gold.dim_brokers(stg_brokers(spark, sf))


def dim_date(spark, sf):
    """The calendar with the number of policies whose trip starts on each day."""
    starts = (
        stg_policies(spark, sf)
        .groupBy(F.col("trip_start_date").alias("__day"))
        .agg(F.count(F.lit(1)).alias("policies_starting"))
    )
    days = gold.dim_date(spark)
    joined = days.join(starts, F.col("date_day") == F.col("__day"), "left").drop("__day")
    return joined.withColumn("policies_starting", F.coalesce("policies_starting", F.lit(0)))


def fact_policies(spark, sf):
    """Joins planned as a GOLD run plans them: stored dimensions, broadcast if counted as small."""
    raw = fixtures.raw_policies(spark, sf)
    dimensions = {
        "customer": stored(spark, sf, "dim_customers"),
        "destination": stored(spark, sf, "dim_destinations"),
        "broker": stored(spark, sf, "dim_brokers"),
    }
    small = [name for name, table in dimensions.items() if small_enough(table)]
    large = [name for name in dimensions if name not in small]
    hot = gold.policy_hot_keys(raw, large) if large else NO_HOT_KEYS
    return gold.fact_policies(
        silver.policies(raw), *dimensions.values(), stored(spark, sf, "dim_date"), hot, small
    )


def fact_claims(spark, sf):
    raw = fixtures.raw_claims(spark, sf)
    parents = stored(spark, sf, "fact_policies")
    small = small_enough(parents)
    hot = NO_HOT_KEYS if small else gold.claim_hot_keys(raw)
    return gold.fact_claims(silver.claims(raw), parents, hot, small)


def fact_policies_incremental(spark, sf):
    """A first run up to a cut, then a second run over everything."""
    root = scratch_dir(spark, "incremental-policies")
    raw = bronze_tables(spark, sf)
    star.build_dimensions(raw, root, AS_OF)
    star.update_policies(raw["raw_policies"].filter(F.col("created_at") <= times.moment(CUT)), root)
    star.update_policies(raw["raw_policies"], root)
    return read_keyed(spark, f"{root}/fact_policies")


def fact_policies_deltas(spark, sf):
    """Later runs write deltas, the last one again with rows that came before; nothing is compacted."""
    return read_keyed(spark, f"{policies_in_deltas(spark, sf)}/fact_policies")


def fact_policies_compacted(spark, sf):
    """The same after the deltas were merged into new files."""
    path = f"{policies_in_deltas(spark, sf)}/fact_policies"
    compact(spark, path)
    return read_keyed(spark, path)


def policies_in_deltas(spark, sf):
    root = scratch_dir(spark, "policies-in-deltas")
    raw = bronze_tables(spark, sf)
    star.build_dimensions(raw, root, AS_OF)
    star.update_policies(raw["raw_policies"].filter(F.col("created_at") <= times.moment(CUT)), root)
    for lookback in (timedelta(days=60), timedelta(days=365)):
        star.update_policies(raw["raw_policies"], root, lookback, most_deltas=5)
    return root


def fact_policies_new_column(spark, sf):
    """The second load brings a column that the first did not have; it reaches the fact."""
    root = scratch_dir(spark, "new-column")
    raw = bronze_tables(spark, sf)
    policies = raw["raw_policies"]
    channel = F.when(F.col("policy_id") % 2 == 0, "web").otherwise("agent")
    loads = (
        policies.filter(F.col("created_at") <= times.moment(CUT)),
        policies.filter(F.col("created_at") > times.moment(CUT)).withColumn("sales_channel", channel),
    )
    star.build_dimensions(raw, root, AS_OF)
    for number, load in enumerate(loads):
        tables.append_load(load, f"{root}/raw_policies", str(number))
        stored_loads = daily.lower_names(tables.read_loads(spark, f"{root}/raw_policies"))
        star.update_policies(stored_loads, root)
    return star.read_gold_table(spark, root, "fact_policies")


def fact_claims_incremental(spark, sf):
    """Claims that came before their policy keep NULL keys."""
    root = scratch_dir(spark, "incremental-claims")
    raw = bronze_tables(spark, sf)
    early = {
        name: raw[name].filter(F.col("created_at") <= times.moment(CUT))
        for name in ("raw_policies", "raw_claims")
    }
    star.build_dimensions(raw, root, AS_OF)
    star.update_policies(early["raw_policies"], root)
    star.update_claims(early["raw_claims"], root)
    star.update_policies(raw["raw_policies"], root)
    star.update_claims(raw["raw_claims"], root)
    return read_keyed(spark, f"{root}/fact_claims")


def fact_claims_colocated(spark, sf):
    """All claims join the bucketed copy of policies, whose second load lies over the first."""
    root = scratch_dir(spark, "colocated")
    raw = bronze_tables(spark, sf)
    star.build_dimensions(raw, root, AS_OF)
    star.update_policies(raw["raw_policies"].filter(F.col("created_at") <= times.moment(CUT)), root)
    link_store.policy_links(spark, root, LINK_BUCKETS)
    star.update_policies(raw["raw_policies"], root, most_deltas=5)
    links = link_store.policy_links(spark, root, LINK_BUCKETS)
    hot = gold.claim_hot_keys(raw["raw_claims"])
    return gold.fact_claims(silver.claims(raw["raw_claims"]), links, hot, colocated=True)


# --- reports --------------------------------------------------------------------------


def revenue_by_month(spark, sf):
    return metrics.revenue_by_month(stored(spark, sf, "fact_policies"))


def revenue_by_month_maintained(spark, sf):
    """Reports named so read the sums of key ranges, of which the last load changed some."""
    return report_store.revenue_by_month(spark, summed_root(spark, sf))


def premium_by_destination_maintained(spark, sf):
    return report_store.premium_by_destination(spark, summed_root(spark, sf))


def revenue_kpis_maintained(spark, sf):
    return report_store.revenue_kpis(spark, summed_root(spark, sf), AS_OF)


def claim_kpis_maintained(spark, sf):
    return report_store.claim_kpis(spark, summed_root(spark, sf))


def claims_by_type_maintained(spark, sf):
    return report_store.claims_by_type(spark, summed_root(spark, sf))


def average_claim_by_destination_maintained(spark, sf):
    return report_store.average_claim_by_destination(spark, summed_root(spark, sf))


def approval_by_type_maintained(spark, sf):
    return report_store.approval_by_type(spark, summed_root(spark, sf))


def summed_root(spark: SparkSession, sf: str) -> str:
    """GOLD tables after two loads, with sums taken between them; built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _summed_roots:
        root = scratch_dir(spark, "summed")
        raw = bronze_tables(spark, sf)
        early = {name: raw[name].filter(F.col("created_at") <= times.moment(CUT)) for name in ("raw_policies", "raw_claims")}
        star.build_star({**raw, **early}, root, AS_OF)
        for name in star.FACTS:
            report_store.current_cells(spark, root, name)
        star.build_star(raw, root, AS_OF, most_deltas=5)
        _summed_roots[key] = root
    return _summed_roots[key]


def premium_by_destination(spark, sf):
    return metrics.premium_by_destination(stored(spark, sf, "fact_policies"), stored(spark, sf, "dim_destinations"))


def revenue_kpis(spark, sf):
    return metrics.revenue_kpis(revenue_by_month(spark, sf), AS_OF)


def claim_kpis(spark, sf):
    return metrics.claim_kpis(stored(spark, sf, "fact_claims"))


def claims_by_type(spark, sf):
    return metrics.claims_by_type(stored(spark, sf, "fact_claims"))


def average_claim_by_destination(spark, sf):
    return metrics.average_claim_by_destination(stored(spark, sf, "fact_claims"), stored(spark, sf, "dim_destinations"))


def approval_by_type(spark, sf):
    return metrics.approval_by_type(stored(spark, sf, "fact_claims"))


def recent_claims(spark, sf):
    return metrics.recent_claims(stored(spark, sf, "fact_claims"))


def broker_leaderboard(spark, sf):
    return metrics.broker_leaderboard(stored(spark, sf, "dim_brokers"))


def broker_leaderboard_country(spark, sf):
    return metrics.broker_leaderboard(stored(spark, sf, "dim_brokers"), country="NATION_7")


def top_brokers(spark, sf):
    return metrics.top_brokers(stored(spark, sf, "dim_brokers"))


def broker_points(spark, sf):
    return metrics.broker_points(stored(spark, sf, "dim_brokers"))


def broker_countries(spark, sf):
    return metrics.broker_countries(stored(spark, sf, "dim_brokers"))


def flights_by_country(spark, sf):
    by_country = metrics.flights_by_country(stg_flights(spark, sf))
    return rounded(by_country, "avg_altitude", "avg_velocity")


def total_flights(spark, sf):
    return metrics.total_flights(metrics.flights_by_country(stg_flights(spark, sf)))


def top_countries(spark, sf):
    return metrics.top_countries(metrics.flights_by_country(stg_flights(spark, sf)))


def latest_flights(spark, sf):
    return metrics.latest_flights(fixtures.raw_flights(spark, sf))


def ad_hoc_query(spark, sf):
    text = """
        SELECT coverage_type, policy_status, count(*) AS policy_count,
               count(date_sk) AS dated_policies
        FROM {policies} GROUP BY coverage_type, policy_status
    """
    return tables.run_query(spark, text, {"policies": stored(spark, sf, "fact_policies")})


def ad_hoc_query_reused(spark, sf):
    """A query asked twice over the stored facts; the second answer is the stored result."""
    text = """
        SELECT d.destination_country, count(*) AS policy_count, sum(f.premium_amount) AS total_premium
        FROM {fact_policies} f LEFT JOIN {dim_destinations} d ON f.destination_sk = d.destination_sk
        GROUP BY d.destination_country ORDER BY policy_count DESC, d.destination_country
    """
    results, names = scratch_dir(spark, "results"), ("fact_policies", "dim_destinations")
    for _ in range(2):
        answer = result_store.query(spark, text, star_root(spark, sf, names), names, results, AS_OF)
    return answer


# --- quality, reconciliation, monitoring ------------------------------------------------


def quality_report(spark, sf):
    return quality.gold_report(star.read_gold(spark, star_root(spark, sf)))


def quality_report_incremental(spark, sf):
    """The report after a second load; it scans only the ranges that load wrote."""
    root = scratch_dir(spark, "incremental-checks")
    raw = bronze_tables(spark, sf)
    early = {name: raw[name].filter(F.col("created_at") <= times.moment(CUT)) for name in ("raw_policies", "raw_claims")}
    star.build_star({**raw, **early}, root, AS_OF)
    check_store.gold_report(spark, root).collect()
    star.build_star(raw, root, AS_OF)
    return check_store.gold_report(spark, root)


def differing_policy_ranges(spark, sf):
    """Ranges of 100 keys in which the changed copy differs; both have equally many rows."""
    return reconcile.differing_ranges(*policies_and_changed_copy(spark, sf), "policy_id", spans=(10_000, 100))


def differing_policies(spark, sf):
    rows = reconcile.differing_rows(*policies_and_changed_copy(spark, sf), "policy_id", spans=(10_000, 100))
    return rows.withColumn("differing_columns", F.concat_ws(",", "differing_columns"))


def policies_and_changed_copy(spark, sf):
    """The policy fact, and a copy with other premiums and other keys by a fixed rule."""
    columns = ("policy_id", "customer_id", "destination_country", "premium_amount", "policy_status")
    rows = stored(spark, sf, "fact_policies").select(*columns)
    key, premium = F.col("policy_id"), F.col("premium_amount")
    raised = F.when(key % 997 == 5, premium + 1).otherwise(premium).cast("decimal(12,2)")
    moved = F.when(key % 1009 == 7, key + 100_000_000).otherwise(key)
    return rows, rows.withColumns({"premium_amount": raised, "policy_id": moved})


def source_constraints(spark, sf):
    raw = bronze_tables(spark, sf)
    return quality.source_report(raw["raw_customers"], raw["raw_policies"], raw["raw_claims"])


def non_positive_claims(spark, sf):
    return quality.non_positive_claims(stored(spark, sf, "fact_claims"))


def orphan_claims(spark, sf):
    return missing_parents(stored(spark, sf, "fact_claims"), "policy_id", stored(spark, sf, "fact_policies"), "policy_id")


def freshness_report(spark, sf):
    raw = bronze_tables(spark, sf)
    raw_flights = fixtures.raw_flights(spark, sf)
    clean = bronze.clean_flights(raw_flights, LANDING_AS_OF)
    return quality.freshness(
        {
            "raw_customers": (raw["raw_customers"], "created_at"),
            "raw_policies": (raw["raw_policies"], "created_at"),
            "raw_claims": (raw["raw_claims"], "created_at"),
            "raw_broker_commissions": (raw["raw_broker_commissions"], "report_date"),
            "raw_flights": (raw_flights, "ingested_at"),
            "flight_daily_stats": (bronze.flight_daily_stats(clean), "flight_day"),
            "bronze_flights_clean": (clean, "ingested_at"),
        },
        LANDING_AS_OF,
    )


def reconciliation(spark, sf):
    raw = bronze_tables(spark, sf)
    return reconcile.reconcile(
        {
            "customers": (raw["raw_customers"], stored(spark, sf, "dim_customers")),
            "policies": (raw["raw_policies"], stored(spark, sf, "fact_policies")),
            "claims": (raw["raw_claims"], stored(spark, sf, "fact_claims")),
        }
    )


def reconciliation_verdict(spark, sf):
    return reconcile.verdict(reconciliation(spark, sf))


def freshness_gate(spark, sf):
    raw = bronze_tables(spark, sf)
    return monitor.source_activity(raw["raw_policies"], raw["raw_claims"], EVENTS_AS_OF)


def partition_lag(spark, sf):
    return monitor.partition_lag(fixtures.stream_offsets(spark, sf))


def stream_lag(spark, sf):
    return monitor.stream_lag(fixtures.stream_offsets(spark, sf))


def landing_freshness(spark, sf):
    return monitor.landing_freshness(fixtures.raw_flights(spark, sf), LANDING_AS_OF)


# --- function families over whole tables --------------------------------------------------


def calendar_parts(spark, sf):
    """Calendar expressions over every trip."""
    start = F.col("trip_start_date")
    return fixtures.raw_policies(spark, sf).select(
        "policy_id",
        "created_at",
        start.alias("trip_start_date"),
        F.to_date("created_at").alias("created_day"),
        times.month_start(start).alias("month_start"),
        F.year(start).alias("year"),
        F.month(start).alias("month"),
        F.quarter(start).alias("quarter"),
        times.weekday_number(start).alias("day_of_week"),
        times.is_weekend(start).alias("is_weekend"),
        times.days_between(start, F.col("trip_end_date")).alias("trip_days"),
    )


def commissions(spark, sf):
    """Commission from premium and rate, and the rate in percent."""
    return fixtures.raw_brokers(spark, sf).select(
        "broker_id",
        "report_date",
        numbers.commission(
            F.col("total_premium_value"), F.col("commission_rate").cast("decimal(5,4)")
        )
        .cast("decimal(12,2)")
        .alias("commission"),
        numbers.percentage(F.col("commission_rate")).alias("commission_percentage"),
    )


def parsed_timestamps(spark, sf):
    """Order times as text in several forms, read back tolerantly."""
    key = F.col("o_orderkey")
    moment_ = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (key % 86400).cast("decimal(18,6)")
    )
    plain = F.date_format(moment_, "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(key % 5 == 0, F.concat(F.date_format(moment_, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
        .when(key % 5 == 1, F.date_format(moment_, "yyyy-MM-dd"))
        .when(key % 5 == 2, F.concat(F.lit("on "), plain))
        .when(key % 5 == 3, times.seconds_between(times.moment(datetime(1970, 1, 1)), moment_).cast("string"))
        .otherwise(plain)
    )
    orders = fixtures.read(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return orders.select("o_orderkey", times.timestamp_of(orders, "text").alias("parsed"))


# --- streams --------------------------------------------------------------------------


def _drained(spark, purpose, start) -> str:
    root = scratch_dir(spark, purpose)
    query = start(f"{root}/table", f"{root}/checkpoint")
    query.awaitTermination()
    return f"{root}/table"


def stream_flight_ingest(spark, sf):
    source = fixtures.flight_message_stream(spark, sf)
    stamp = times.moment(LANDING_AS_OF)
    path = _drained(
        spark, "ingest", lambda table, mark: flight_stream.start_ingest(source, table, mark, stamp)
    )
    return flight_stream.landed_flights(spark, path)


def stream_flight_restart(spark, sf):
    """Messages in bounded micro-batches; the stream ends, more files come, and it starts again."""
    root = scratch_dir(spark, "restart")
    sent, stamp = fixtures.flight_messages(spark, sf), times.moment(LANDING_AS_OF)
    part = F.pmod(F.xxhash64("key", "value"), F.lit(4))
    for parts in ((0, 1), (2, 3)):
        for number in parts:
            topics.write_message_files(sent.filter(part == number), f"{root}/in")
        # A drop has a file of every task that wrote it; a batch takes as many as run side by side.
        source = topics.read_message_files(spark, f"{root}/in", max_files_per_batch=spark.sparkContext.defaultParallelism)
        flight_stream.start_ingest(source, f"{root}/table", f"{root}/mark", stamp).awaitTermination()
    return flight_stream.landed_flights(spark, f"{root}/table")


def stream_flight_rejects(spark, sf):
    source = fixtures.flight_message_stream(spark, sf)
    path = _drained(
        spark, "rejects", lambda table, mark: flight_stream.start_ingest(source, table, mark)
    )
    return flight_stream.landed_rejects(spark, path)


def stream_flight_dedup(spark, sf):
    """Rows of the windows the watermark has closed."""
    latest = flight_stream.deduplicate(fixtures.raw_flight_stream(spark, sf), delay=STREAM_DELAY)
    path = _drained(
        spark, "dedup", lambda table, mark: flight_stream.start_sink(latest, table, mark)
    )
    return spark.read.schema(latest.schema).parquet(path)


def stream_flight_states(spark, sf):
    keyed = flight_stream.state_messages(fixtures.api_response_stream(spark, sf), LANDING_AS_OF)
    path = _drained(
        spark, "states", lambda table, mark: flight_stream.start_sink(keyed, table, mark)
    )
    return spark.read.schema(keyed.schema).parquet(path)


def stream_policy_events(spark, sf):
    """Purchases arrive in three drops, with repeats inside a drop and across two of them."""
    root = scratch_dir(spark, "purchase-files")
    created, raw = F.col("created_at"), fixtures.first_policies(spark, sf)
    for low, high in pairwise(PURCHASE_FILES):
        new = raw.filter((created > times.moment(low)) & (created <= times.moment(high)))
        again = raw.filter((created > times.moment(low - timedelta(minutes=30))) & (created <= times.moment(low)))
        rows = new.union(new.filter("policy_id % 5 = 0")).union(again)
        rows.write.mode("append").parquet(f"{root}/in")
        # A drop has a file of every task; the stream takes them as one batch and stops before the next drop.
        source = spark.readStream.schema(raw.schema).parquet(f"{root}/in")
        events = policy_stream.purchase_stream(source)
        flight_stream.start_sink(events, f"{root}/table", f"{root}/mark").awaitTermination()
    stored = spark.read.schema(events.schema).parquet(f"{root}/table")
    # The event time is the moment of publishing, so only the stable part is shown.
    return stored.select(
        "key",
        F.get_json_object("value", "$.policy_number").alias("policy_number"),
        F.get_json_object("value", "$.trip_start_date").alias("trip_start_date"),
        F.get_json_object("value", "$.created_at").alias("created_at"),
        F.get_json_object("value", "$.event_type").alias("event_type"),
    )


def daily_root(spark: SparkSession, sf: str) -> str:
    """Folder of one whole daily run over an input folder, made on first use in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _daily_roots:
        root = scratch_dir(spark, "daily")
        raw = bronze_tables(spark, sf)
        for day in ("2024-01-01", "2024-01-02"):
            report = raw["raw_broker_commissions"].filter(F.col("report_date") == F.lit(day).cast("date"))
            broker_files.write_drop(report, f"{root}/drops", day)
        landing = f"{root}/landing"
        flight_stream.start_ingest(
            fixtures.flight_message_stream(spark, sf), landing, f"{root}/landing-mark"
        ).awaitTermination()
        sources = {
            "customers": raw["raw_customers"],
            "policies": raw["raw_policies"],
            "claims": raw["raw_claims"],
        }
        daily.run_daily(sources, f"{root}/drops", landing, f"{root}/lake", EVENTS_AS_OF)
        _daily_roots[key] = root
    return _daily_roots[key]


def daily_run(spark, sf):
    """The states of a daily run, one row per step.

    The inputs hold rows that break declared checks, so the quality step must report it and
    reconciliation must still run.
    """
    reports = f"{daily_root(spark, sf)}/lake/reports/status_*"
    return spark.read.schema(monitor.STATUS_SCHEMA).json(reports).select("step", "state")


def daily_run_summary(spark, sf):
    """How many steps of the daily run failed or were blocked."""
    return monitor.status_summary(daily_run(spark, sf))


def daily_run_policies(spark, sf):
    """The policy fact as the daily run stored it."""
    return star.read_gold_table(spark, f"{daily_root(spark, sf)}/lake/gold", "fact_policies")


def daily_run_flight_stats(spark, sf):
    """The flight statistics of the daily run, from landed messages."""
    stats = bronze.read_flight_stats(spark, f"{daily_root(spark, sf)}/lake/bronze")
    return rounded(stats, "avg_altitude", "avg_velocity", "pct_on_ground")


def daily_run_quality(spark, sf):
    """The quality report that the daily run stored."""
    path = f"{daily_root(spark, sf)}/lake/reports/quality"
    return spark.read.schema(quality.REPORT_SCHEMA).json(path).select(*quality.REPORT_COLUMNS)


def daily_run_flights(spark, sf):
    """The clean flights of the daily run, from landed messages."""
    root = daily_root(spark, sf)
    landed = flight_stream.landed_flights(spark, f"{root}/landing")
    return bronze.read_clean_flights(landed, f"{root}/lake/bronze").drop("ingested_at")


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        clean_flights_30s, clean_flights_1h, clean_policies, flight_daily_stats,
        flight_daily_report, cleaning_removed_rows, trimmed_claims, event_buckets,
        bronze_row_counts, incremental_extract, extract_run, appended_customers,
        newest_broker_drop, flight_messages_accepted, flight_messages_rejected, flight_states,
        flight_state_messages, recent_policies, policy_events, published_policies,
        refreshed_flights, fact_policies_new_column, stg_customers, stg_policies,
        stg_claims, stg_brokers, stg_flights, stg_flight_stats, silver_policies_incremental,
        silver_claims_incremental, silver_customers_incremental, dim_customers,
        dim_destinations, dim_brokers, dim_date, fact_policies, fact_claims,
        fact_policies_incremental, fact_claims_incremental, revenue_by_month,
        premium_by_destination, revenue_kpis, claim_kpis, claims_by_type,
        average_claim_by_destination, approval_by_type, recent_claims, broker_leaderboard,
        broker_leaderboard_country, top_brokers, broker_points, broker_countries,
        flights_by_country, total_flights, top_countries, latest_flights, ad_hoc_query, ad_hoc_query_reused,
        fact_policies_deltas, fact_policies_compacted, quality_report_incremental,
        quality_report, source_constraints, non_positive_claims, orphan_claims,
        freshness_report, reconciliation, reconciliation_verdict, freshness_gate,
        partition_lag, stream_lag, landing_freshness, calendar_parts, commissions,
        parsed_timestamps, stream_flight_ingest, stream_flight_restart, stream_flight_rejects, stream_flight_dedup,
        stream_flight_states, stream_policy_events, daily_run,
        daily_run_summary, daily_run_policies, daily_run_flight_stats, daily_run_quality,
        daily_run_flights, revenue_by_month_maintained, premium_by_destination_maintained,
        revenue_kpis_maintained, claim_kpis_maintained, claims_by_type_maintained,
        average_claim_by_destination_maintained, approval_by_type_maintained,
        differing_policy_ranges, differing_policies, fact_claims_colocated,
    )
}
