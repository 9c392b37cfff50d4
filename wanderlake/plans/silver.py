"""SILVER: standardised views over BRONZE."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderlake import schemas
from wanderlake.fixed_values import ISO_CODE_BY_COUNTRY, STANDARD_TRUE_TEXT, UNKNOWN_ISO_CODE
from wanderlake.functions.numbers import decimal_or_null, percentage, whole_number
from wanderlake.functions.text import (
    blank_to_null,
    full_name,
    is_true_text,
    mapped,
    tidy_lower,
    tidy_upper,
)
from wanderlake.functions.times import days_between, days_to_process, moment, timestamp_of
from wanderlake.operators.latest import latest_per_key


def changed_since(raw: DataFrame, created_after: datetime | None) -> DataFrame:
    """Rows that can decide which records are newer than the mark: newer or undated ones.

    A key whose latest row is newer than the mark has that row among these, so older rows
    need not reach the shuffle. The mark is a literal, so the scan skips old row groups.
    Whether the latest row itself is newer is tested once it is known.
    """
    if created_after is None:
        return raw
    created = timestamp_of(raw, "created_at")
    return raw.filter((created > moment(created_after)) | created.isNull())


def _newest(raw: DataFrame, key: str, created_after: datetime | None) -> DataFrame:
    return latest_rows(changed_since(raw, created_after), key)


def latest_rows(raw: DataFrame, key: str) -> DataFrame:
    """Latest row per key by creation time, unknown times first."""
    return latest_per_key(raw, [key], ["created_at"], unknown_first=True)


def after(df: DataFrame, created_after: datetime | None) -> DataFrame:
    """Standardised rows created after a mark; all of them without one."""
    if created_after is None:
        return df
    return df.filter(F.col("created_at") > moment(created_after))


def customers(raw: DataFrame) -> DataFrame:
    return standard_customers(_newest(raw, "customer_id", None))


def standard_customers(latest: DataFrame) -> DataFrame:
    """SILVER form of the latest rows of RAW customers."""
    country = F.col("country_of_residence")
    return latest.select(
        "customer_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        tidy_lower(F.col("email")).alias("email"),
        "date_of_birth",
        F.trim(country).alias("country_of_residence"),
        mapped(tidy_upper(country), ISO_CODE_BY_COUNTRY, UNKNOWN_ISO_CODE).alias("country_iso_code"),
        F.trim("phone").alias("phone"),
        timestamp_of(latest, "created_at").alias("created_at"),
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
    )


def policies(raw: DataFrame, created_after: datetime | None = None) -> DataFrame:
    """Cancelled policies that never had a premium are left out.

    The test sees the raw premium: text that is no number counts as a premium. With an
    unknown status and no premium it is neither true nor false, and the row goes too.
    Columns that the source has got since pass through as they are.
    """
    return after(standard_policies(_newest(raw, "policy_id", created_after)), created_after)


def standard_policies(latest: DataFrame) -> DataFrame:
    """SILVER form of the latest rows of RAW policies."""
    status = tidy_lower(F.col("status"))
    kept = latest.filter(~((status == "cancelled") & F.col("premium_amount").isNull()))
    return (
        kept.select(
            "policy_id",
            "customer_id",
            F.trim("policy_number").alias("policy_number"),
            F.trim("destination_country").alias("destination_country"),
            "trip_start_date",
            "trip_end_date",
            tidy_upper(F.col("coverage_type")).alias("coverage_type"),
            decimal_or_null(F.col("premium_amount"), 10, 2).alias("premium_amount"),
            status.alias("policy_status"),
            "broker_id",
            timestamp_of(latest, "created_at").alias("created_at"),
            days_between(F.col("trip_start_date"), F.col("trip_end_date")).alias(
                "trip_duration_days"
            ),
            *(F.col(f"`{c}`") for c in latest.columns if c not in schemas.POLICIES),
        )
    )


def claims(raw: DataFrame, created_after: datetime | None = None) -> DataFrame:
    return after(standard_claims(_newest(raw, "claim_id", created_after)), created_after)


def standard_claims(latest: DataFrame) -> DataFrame:
    """SILVER form of the latest rows of RAW claims."""
    status = tidy_lower(F.col("status"))
    processed = timestamp_of(latest, "processed_at")
    return (
        latest.select(
            "claim_id",
            "policy_id",
            tidy_lower(F.col("claim_type")).alias("claim_type"),
            decimal_or_null(F.col("claim_amount"), 12, 2).alias("claim_amount"),
            "claim_date",
            status.alias("claim_status"),
            "description",
            processed.alias("processed_at"),
            timestamp_of(latest, "created_at").alias("created_at"),
            days_to_process(F.col("claim_date"), F.col("processed_at"), processed).alias(
                "days_to_process"
            ),
            F.coalesce(status == "approved", F.lit(False)).alias("is_approved"),
        )
    )


def brokers(raw: DataFrame) -> DataFrame:
    """Latest report per broker; of several on one day the best paid one."""
    typed = raw.select(
        "broker_id",
        F.trim("broker_name").alias("broker_name"),
        F.trim("broker_company").alias("broker_company"),
        F.trim("country").alias("country"),
        whole_number(F.col("policies_sold_today")).alias("policies_sold_today"),
        F.col("total_premium_value").cast("decimal(12,2)").alias("total_premium_value"),
        F.col("commission_rate").cast("double").alias("commission_rate"),
        F.col("commission_earned").cast("decimal(12,2)").alias("commission_earned"),
        percentage(F.col("commission_rate")).alias("commission_percentage"),
        "report_date",
    )
    return latest_per_key(
        typed, ["broker_id"], ["report_date", "commission_earned"], unknown_first=True
    )


def flights(clean: DataFrame) -> DataFrame:
    telemetry = ("longitude", "latitude", "altitude", "velocity", "heading")
    return clean.filter(blank_to_null(F.col("callsign")).isNotNull()).select(
        "icao24",
        blank_to_null(F.col("callsign")).alias("callsign"),
        F.trim("origin_country").alias("origin_country"),
        *[F.col(name).cast("double").alias(name) for name in telemetry],
        is_true_text(F.col("on_ground"), STANDARD_TRUE_TEXT, ignore_case=False).alias("on_ground"),
        "event_timestamp",
        "ingested_at",
    )


def flight_stats(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("flight_day").alias("stat_date"),
        "origin_country",
        "flight_count",
        "avg_altitude",
        "avg_velocity",
        "pct_on_ground",
    )
