"""Columns of the source and BRONZE tables: name -> Spark SQL type."""

from __future__ import annotations

from collections.abc import Mapping

CUSTOMERS = {
    "customer_id": "bigint",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "date_of_birth": "date",
    "country_of_residence": "string",
    "phone": "string",
    "created_at": "timestamp_ntz",
}

POLICIES = {
    "policy_id": "bigint",
    "customer_id": "bigint",
    "policy_number": "string",
    "destination_country": "string",
    "trip_start_date": "date",
    "trip_end_date": "date",
    "coverage_type": "string",
    "premium_amount": "decimal(10,2)",
    "status": "string",
    "broker_id": "bigint",
    "created_at": "timestamp_ntz",
}

CLAIMS = {
    "claim_id": "bigint",
    "policy_id": "bigint",
    "claim_type": "string",
    "claim_amount": "decimal(10,2)",
    "claim_date": "date",
    "status": "string",
    "description": "string",
    "processed_at": "timestamp_ntz",
    "created_at": "timestamp_ntz",
}

RAW_FLIGHTS = {
    "icao24": "string",
    "callsign": "string",
    "origin_country": "string",
    "longitude": "double",
    "latitude": "double",
    "altitude": "double",
    "velocity": "double",
    "heading": "double",
    "on_ground": "boolean",
    "event_timestamp": "timestamp_ntz",
    "ingested_at": "timestamp_ntz",
}

RAW_BROKER_COMMISSIONS = {
    "broker_id": "bigint",
    "broker_name": "string",
    "broker_company": "string",
    "country": "string",
    "policies_sold_today": "bigint",
    "total_premium_value": "decimal(12,2)",
    "commission_rate": "double",
    "commission_earned": "decimal(12,2)",
    "report_date": "date",
}

FACT_POLICIES = {
    "policy_id": "bigint",
    "customer_sk": "string",
    "destination_sk": "string",
    "broker_sk": "string",
    "date_sk": "string",
    "customer_id": "bigint",
    "destination_country": "string",
    "broker_id": "bigint",
    "trip_start_date": "date",
    "trip_end_date": "date",
    "premium_amount": "decimal(10,2)",
    "coverage_type": "string",
    "trip_duration_days": "int",
    "policy_status": "string",
    "created_at": "timestamp_ntz",
}

FACT_CLAIMS = {
    "claim_id": "bigint",
    "policy_id": "bigint",
    "customer_sk": "string",
    "destination_sk": "string",
    "broker_sk": "string",
    "date_sk": "string",
    "destination_country": "string",
    "claim_type": "string",
    "claim_amount": "decimal(12,2)",
    "claim_status": "string",
    "is_approved": "boolean",
    "days_to_process": "int",
    "claim_date": "date",
    "processed_at": "timestamp_ntz",
    "created_at": "timestamp_ntz",
}

# Flight message on the wire: field -> column type once decoded.
FLIGHT_MESSAGE_FIELDS = {
    "icao24": "string",
    "callsign": "string",
    "origin_country": "string",
    "longitude": "double",
    "latitude": "double",
    "altitude": "double",
    "velocity": "double",
    "heading": "double",
    "on_ground": "boolean",
    "timestamp": "timestamp_ntz",
}

# Position of each telemetry field in the API's state vector.
STATE_VECTOR_POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "longitude": 5,
    "latitude": 6,
    "altitude": 7,
    "velocity": 9,
    "heading": 10,
    "on_ground": 8,
}


def ddl(columns: Mapping[str, str]) -> str:
    """Schema text for readers and createDataFrame."""
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
