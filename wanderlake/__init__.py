"""Medallion analytics for travel-insurance and flight-telemetry data on Spark."""
