"""Business reports over GOLD and SILVER."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderlake.functions.numbers import percent_of
from wanderlake.functions.times import month_start
from wanderlake.operators.ranking import top_rows


def revenue_by_month(fact_policies: DataFrame) -> DataFrame:
    return (
        fact_policies.groupBy(month_start(F.col("trip_start_date")).alias("month"))
        .agg(
            F.sum("premium_amount").alias("total_premium"),
            F.count(F.lit(1)).alias("policy_count"),
        )
        .orderBy("month")
    )


def premium_by_destination(fact_policies: DataFrame, destinations: DataFrame) -> DataFrame:
    """Premiums are summed per key first: the label join then sees one row per destination."""
    return premiums_labelled(
        fact_policies.groupBy("destination_sk").agg(F.sum("premium_amount").alias("premium")), destinations
    )


def premiums_labelled(per_key: DataFrame, destinations: DataFrame) -> DataFrame:
    """Total premium per destination label, from one ``premium`` per key."""
    return (
        _labelled(per_key, destinations)
        .groupBy("destination_country")
        .agg(F.sum("premium").cast("decimal(38,2)").alias("total_premium"))
        .orderBy(F.desc_nulls_first("total_premium"), "destination_country")
    )


def revenue_kpis(by_month: DataFrame, as_of: datetime) -> DataFrame:
    """This year's revenue, all policies, and their ratio.

    The ratio divides this year's revenue by the policies of all years, as the published
    report does.
    """
    this_year = F.year("month") == as_of.year
    totals = by_month.agg(
        F.coalesce(F.sum(F.when(this_year, F.col("total_premium"))).cast("double"), F.lit(0.0)).alias(
            "total_revenue_this_year"
        ),
        F.coalesce(F.sum("policy_count"), F.lit(0)).alias("total_policies"),
    )
    revenue, policies = F.col("total_revenue_this_year"), F.col("total_policies")
    return totals.withColumn(
        "average_premium", F.when(policies > 0, revenue / policies).otherwise(F.lit(0.0))
    )


def claim_kpis(fact_claims: DataFrame) -> DataFrame:
    counted = fact_claims.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.sum(F.when(F.col("is_approved"), 1).otherwise(0)).alias("approved_claims"),
    )
    return approval_rate(counted)


def approval_rate(counted: DataFrame) -> DataFrame:
    return counted.withColumn(
        "approval_rate", percent_of(F.col("approved_claims"), F.col("total_claims"))
    )


def claims_by_type(fact_claims: DataFrame) -> DataFrame:
    return (
        fact_claims.groupBy("claim_type")
        .agg(F.count(F.lit(1)).alias("claim_count"))
        .orderBy(F.desc_nulls_first("claim_count"), "claim_type")
    )


def average_claim_by_destination(fact_claims: DataFrame, destinations: DataFrame) -> DataFrame:
    """Average claim per destination label, from sums and counts per key."""
    per_key = fact_claims.groupBy("destination_sk").agg(
        F.sum("claim_amount").alias("amount"), F.count("claim_amount").alias("claims")
    )
    return averages_labelled(per_key, destinations)


def averages_labelled(per_key: DataFrame, destinations: DataFrame) -> DataFrame:
    """Average claim per destination label, from one ``amount`` and number of ``claims`` per key."""
    average = F.try_divide(F.sum("amount").cast("decimal(28,2)"), F.sum("claims"))
    return (
        _labelled(per_key, destinations)
        .groupBy("destination_country")
        .agg(average.cast("decimal(16,6)").alias("avg_claim_amount"))
        .orderBy(F.desc_nulls_first("avg_claim_amount"), "destination_country")
    )


def approval_by_type(fact_claims: DataFrame) -> DataFrame:
    return (
        fact_claims.filter(F.col("claim_status").isin("approved", "rejected"))
        .groupBy("claim_type", "claim_status")
        .agg(F.count(F.lit(1)).alias("claim_count"))
        .orderBy("claim_type", "claim_status")
    )


def recent_claims(fact_claims: DataFrame, n: int = 20) -> DataFrame:
    newest = top_rows(fact_claims, n, F.desc_nulls_first("claim_date"), F.col("claim_id"))
    return newest.select(
        "claim_date",
        "destination_country",
        "claim_type",
        "claim_amount",
        F.col("claim_status").alias("status"),
    )


def broker_leaderboard(dim_brokers: DataFrame, country: str | None = None) -> DataFrame:
    """All brokers by commission; ``country`` None stands for all countries."""
    chosen = dim_brokers if country is None else dim_brokers.filter(F.col("country") == country)
    return chosen.select(
        "broker_id",
        "broker_name",
        "broker_company",
        "country",
        "policies_sold_today",
        "total_premium_value",
        "commission_rate",
        "commission_percentage",
        "commission_earned",
        "report_date",
    ).orderBy(F.desc_nulls_first("commission_earned"), "broker_id")


def top_brokers(dim_brokers: DataFrame, n: int = 15, country: str | None = None) -> DataFrame:
    """The best paid brokers, shown from the lowest to the highest of them."""
    chosen = dim_brokers if country is None else dim_brokers.filter(F.col("country") == country)
    best = top_rows(
        chosen.select("broker_id", "broker_name", "commission_earned"),
        n,
        F.desc_nulls_first("commission_earned"),
        F.col("broker_id"),
    )
    return best.orderBy(F.asc("commission_earned"), F.desc("broker_id"))


def broker_points(dim_brokers: DataFrame, country: str | None = None) -> DataFrame:
    """Policies sold against commission earned, one point per broker."""
    chosen = dim_brokers if country is None else dim_brokers.filter(F.col("country") == country)
    return chosen.select("broker_name", "country", "policies_sold_today", "commission_earned")


def broker_countries(dim_brokers: DataFrame) -> DataFrame:
    return dim_brokers.filter(F.col("country").isNotNull()).select("country").distinct().orderBy("country")


def flights_by_country(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("origin_country")
        .agg(
            F.count(F.lit(1)).alias("flight_count"),
            F.avg("altitude").alias("avg_altitude"),
            F.avg("velocity").alias("avg_velocity"),
            F.sum(F.when(F.col("on_ground"), 1).otherwise(0)).alias("ground_count"),
        )
        .orderBy(F.desc_nulls_first("flight_count"), "origin_country")
    )


def total_flights(by_country: DataFrame) -> DataFrame:
    return by_country.agg(F.coalesce(F.sum("flight_count"), F.lit(0)).alias("total_flights"))


def top_countries(by_country: DataFrame, n: int = 20) -> DataFrame:
    best = top_rows(by_country, n, F.desc_nulls_first("flight_count"), F.col("origin_country"))
    return best.select("origin_country", "flight_count")


def latest_flights(raw_flights: DataFrame, n: int = 50) -> DataFrame:
    """Newest raw events; the event time and aircraft settle equal load times."""
    shown = ("icao24", "callsign", "origin_country", "altitude", "velocity", "on_ground", "ingested_at")
    newest = top_rows(
        raw_flights,
        n,
        F.desc_nulls_first("ingested_at"),
        F.desc_nulls_last("event_timestamp"),
        F.col("icao24"),
    )
    return newest.select(*shown)


def _labelled(per_key: DataFrame, destinations: DataFrame) -> DataFrame:
    labels = destinations.select(F.col("destination_sk").alias("__sk"), "destination_country")
    return per_key.join(labels, F.col("destination_sk") == F.col("__sk"), "left")
