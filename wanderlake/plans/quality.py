"""Data-quality checks, declared per column and evaluated together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderlake.fixed_values import (
    CLAIM_STATUSES,
    CLAIM_TYPES,
    COVERAGE_TYPES,
    ERROR_HOURS,
    POLICY_STATUSES,
    WARN_HOURS,
)
from wanderlake.functions.times import moment, seconds_between
from wanderlake.operators.lookup import missing_parents

REPORT_COLUMNS = ("table_name", "check_name", "column_name", "failures", "status")
REPORT_SCHEMA = "table_name string, check_name string, column_name string, failures bigint, status string"


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """NULL passes."""

    column: str
    values: Sequence[str]
    name = "accepted_values"

    def failing(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class ExpressionIsTrue:
    """SQL condition on the column, such as ``> 0``; NULL passes."""

    column: str
    condition: str
    name = "expression_is_true"

    def failing(self) -> Column:
        return ~F.expr(f"`{self.column}` {self.condition}")


@dataclass(frozen=True)
class Unique:
    """Counts the values, NULL aside, that occur more than once."""

    column: str
    name = "unique"

    def failures(self, df: DataFrame) -> DataFrame:
        repeated = (
            df.filter(F.col(self.column).isNotNull())
            .groupBy(self.column)
            .agg(F.count(F.lit(1)).alias("n"))
        )
        return repeated.agg(F.count_if(F.col("n") > 1).alias("failures"))


@dataclass(frozen=True)
class Relationship:
    """Counts rows whose key, when there is one, has no parent."""

    column: str
    parents: DataFrame
    parent_column: str
    name = "relationships"

    def failures(self, df: DataFrame) -> DataFrame:
        missing = missing_parents(df, self.column, self.parents, self.parent_column)
        return missing.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("failures"))


def status() -> Column:
    return F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")


def run_checks(table_name: str, df: DataFrame, checks: Sequence) -> DataFrame:
    """One row per check with its number of failures.

    All row-level checks share one scan and one aggregate; unique and relationship checks
    read their own column only.
    """
    row_level = [c for c in checks if hasattr(c, "failing")]
    reports = []
    if row_level:
        counts = df.agg(*[F.count_if(c.failing()).alias(f"c{i}") for i, c in enumerate(row_level)])
        lines = F.array(
            *[
                F.struct(
                    F.lit(c.name).alias("check_name"),
                    F.lit(c.column).alias("column_name"),
                    F.col(f"c{i}").alias("failures"),
                )
                for i, c in enumerate(row_level)
            ]
        )
        reports.append(counts.select(F.inline(lines)))
    for check in checks:
        if not hasattr(check, "failing"):
            reports.append(
                check.failures(df).select(
                    F.lit(check.name).alias("check_name"),
                    F.lit(check.column).alias("column_name"),
                    "failures",
                )
            )
    return _union(reports).select(F.lit(table_name).alias("table_name"), "check_name", "column_name", "failures", status())


DIMENSION_KEYS = {
    "dim_customers": "customer_sk",
    "dim_destinations": "destination_sk",
    "dim_brokers": "broker_sk",
    "dim_date": "date_sk",
}


def dimension_report(gold: Mapping[str, DataFrame]) -> DataFrame:
    """The declared tests of the dimensions."""
    return _union([run_checks(name, gold[name], [NotNull(key), Unique(key)]) for name, key in DIMENSION_KEYS.items()])


def fact_checks(policies: DataFrame) -> dict[str, list]:
    """The declared tests of each fact; claims are tested against the given policies."""
    return {
        "fact_policies": [
            NotNull("policy_id"),
            Unique("policy_id"),
            AcceptedValues("policy_status", POLICY_STATUSES),
        ],
        "fact_claims": [
            NotNull("claim_id"),
            Unique("claim_id"),
            Relationship("policy_id", policies, "policy_id"),
            ExpressionIsTrue("claim_amount", "> 0"),
        ],
    }


def gold_report(gold: Mapping[str, DataFrame]) -> DataFrame:
    """The declared tests of the star schema."""
    facts = [run_checks(name, gold[name], checks) for name, checks in fact_checks(gold["fact_policies"]).items()]
    return _union([dimension_report(gold), *facts])


def source_report(customers: DataFrame, policies: DataFrame, claims: DataFrame) -> DataFrame:
    """The constraints of the source tables, tested on BRONZE rows."""

    def filled(*names: str) -> list[NotNull]:
        return [NotNull(name) for name in names]

    return _union(
        [
            run_checks(
                "customers",
                customers,
                [
                    *filled(
                        "customer_id", "first_name", "last_name", "email", "date_of_birth",
                        "country_of_residence",
                    ),
                    Unique("customer_id"),
                    Unique("email"),
                ],
            ),
            run_checks(
                "policies",
                policies,
                [
                    *filled(
                        "policy_id", "customer_id", "policy_number", "destination_country",
                        "trip_start_date", "trip_end_date", "coverage_type", "premium_amount",
                        "status", "broker_id",
                    ),
                    Unique("policy_id"),
                    Unique("policy_number"),
                    Relationship("customer_id", customers, "customer_id"),
                    AcceptedValues("coverage_type", COVERAGE_TYPES),
                    AcceptedValues("status", POLICY_STATUSES),
                ],
            ),
            run_checks(
                "claims",
                claims,
                [
                    *filled("claim_id", "policy_id", "claim_type", "claim_amount", "claim_date", "status"),
                    Unique("claim_id"),
                    Relationship("policy_id", policies, "policy_id"),
                    AcceptedValues("claim_type", CLAIM_TYPES),
                    AcceptedValues("status", CLAIM_STATUSES),
                ],
            ),
        ]
    )


def non_positive_claims(fact_claims: DataFrame) -> DataFrame:
    """Claims that break the positive-amount rule."""
    return fact_claims.filter(F.col("claim_amount") <= 0).select("claim_id", "claim_amount")


def freshness(
    sources: Mapping[str, tuple[DataFrame, str]],
    as_of: datetime,
    warn_hours: int = WARN_HOURS,
    error_hours: int = ERROR_HOURS,
) -> DataFrame:
    """Age of the newest row per source: pass, warn or error; an empty source is an error."""
    parts = []
    for name, (df, loaded_at) in sources.items():
        newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
        parts.append(newest.select(F.lit(name).alias("source_name"), "max_loaded_at"))
    age = seconds_between(F.col("max_loaded_at"), moment(as_of))
    return _union(parts).select(
        "source_name",
        "max_loaded_at",
        age.alias("age_seconds"),
        F.when(age.isNull() | (age > error_hours * 3600), "error")
        .when(age > warn_hours * 3600, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
