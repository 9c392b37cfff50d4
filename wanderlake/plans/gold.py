"""GOLD: the star schema."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake import schemas
from wanderlake.fixed_values import (
    CALENDAR_END,
    CALENDAR_START,
    CONTINENT_BY_DESTINATION,
    UNKNOWN_CONTINENT,
)
from wanderlake.functions.text import mapped, surrogate_key
from wanderlake.functions.times import age_in_years, is_weekend, weekday_number
from wanderlake.operators.lookup import NO_HOT_KEYS, HotKeys, find_hot_keys, lookup

# Dimension -> its natural key and surrogate key in the policy fact.
POLICY_LOOKUPS = {
    "customer": ("customer_id", "customer_sk"),
    "destination": ("destination_country", "destination_sk"),
    "broker": ("broker_id", "broker_sk"),
}
INHERITED = ("customer_sk", "destination_sk", "broker_sk", "date_sk", "destination_country")


def dim_customers(customers: DataFrame, as_of: datetime) -> DataFrame:
    return customers.select(
        surrogate_key(F.col("customer_id")).alias("customer_sk"),
        "customer_id",
        "first_name",
        "last_name",
        "full_name",
        "email",
        "date_of_birth",
        age_in_years(F.col("date_of_birth"), as_of).alias("customer_age"),
        "country_of_residence",
        "country_iso_code",
        "phone",
        "created_at",
    )


def dim_destinations(policies: DataFrame) -> DataFrame:
    """One row per destination in upper case, one for the unknown destination."""
    names = policies.select(F.upper("destination_country").alias("destination_country")).distinct()
    name = F.col("destination_country")
    return names.select(
        surrogate_key(name).alias("destination_sk"),
        name,
        mapped(name, CONTINENT_BY_DESTINATION, UNKNOWN_CONTINENT).alias("continent"),
    )


def dim_brokers(brokers: DataFrame) -> DataFrame:
    return brokers.select(
        surrogate_key(F.col("broker_id")).alias("broker_sk"),
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
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day from start to end, both included.

    Weekends are Saturday and Sunday; the weekday number counts from Sunday 0.
    """
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    days = spark.range(1).select(F.explode(span).alias("date_day"))
    day = F.col("date_day")
    return days.select(
        surrogate_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        weekday_number(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
    )


def policy_hot_keys(policies: DataFrame, names: Collection[str] = tuple(POLICY_LOOKUPS)) -> HotKeys:
    """Keys of the named dimensions that hold an outsized share of the policies.

    Give it the table before it is deduplicated: that is a scan of the key columns only.
    """
    keys = {
        "customer": F.col("customer_id"),
        "destination": F.upper(F.trim("destination_country")),
        "broker": F.col("broker_id"),
    }
    return find_hot_keys(policies, {name: keys[name] for name in names})


SILVER_POLICIES = frozenset(schemas.POLICIES) | {"policy_status", "trip_duration_days"}


def fact_policies(
    policies: DataFrame,
    customers: DataFrame,
    destinations: DataFrame,
    brokers: DataFrame,
    dates: DataFrame,
    hot: HotKeys = NO_HOT_KEYS,
    small: Collection[str] = (),
    few: bool = False,
) -> DataFrame:
    """Policies with the keys of their dimensions; an unmatched policy keeps NULL keys.

    Columns that SILVER did not always have come last.

    ``small`` names the dimensions that were counted and may be broadcast; ``few`` tells
    that the policies themselves were counted and are no more than that.
    """
    dimensions = {"customer": customers, "destination": destinations, "broker": brokers}
    joined = policies
    for name, (natural_key, surrogate) in POLICY_LOOKUPS.items():
        wanted = F.upper(natural_key) if name == "destination" else F.col(natural_key)
        table = dimensions[name].select(F.col(natural_key).alias("__natural"), surrogate)
        joined = lookup(
            joined, table, wanted, "__natural", name, hot, ["policy_id"], name in small, few
        )
    # The calendar has one row per day of a fixed span, so its size does not grow with data.
    calendar = F.broadcast(dates.select("date_day", "date_sk"))
    joined = joined.join(calendar, F.col("trip_start_date") == F.col("date_day"), "left")
    return joined.select(
        "policy_id",
        "customer_sk",
        "destination_sk",
        "broker_sk",
        "date_sk",
        "customer_id",
        F.upper("destination_country").alias("destination_country"),
        "broker_id",
        "trip_start_date",
        "trip_end_date",
        "premium_amount",
        "coverage_type",
        "trip_duration_days",
        "policy_status",
        "created_at",
        *(c for c in policies.columns if c not in SILVER_POLICIES),
    )


def claim_hot_keys(claims: DataFrame) -> HotKeys:
    """Policies that hold an outsized share of the claims (table before deduplication)."""
    return find_hot_keys(claims, {"policy": F.col("policy_id")})


def fact_claims(
    claims: DataFrame,
    policies: DataFrame,
    hot: HotKeys = NO_HOT_KEYS,
    small: bool = False,
    few: bool = False,
    colocated: bool = False,
) -> DataFrame:
    """Claims with the keys of their policy; NULL keys when the policy is not there (yet)."""
    table = policies.select(F.col("policy_id").alias("__natural"), *INHERITED)
    joined = lookup(
        claims, table, F.col("policy_id"), "__natural", "policy", hot, ["claim_id"], small, few, colocated
    )
    return joined.select(
        "claim_id",
        "policy_id",
        *INHERITED,
        "claim_type",
        "claim_amount",
        "claim_status",
        "is_approved",
        "days_to_process",
        "claim_date",
        "processed_at",
        "created_at",
    )
