"""Staging: typed, renamed projections of the raw tables (lazy views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_facilities(raw_facilities: DataFrame) -> DataFrame:
    return raw_facilities.select(
        "facility_id", "facility_name", "facility_type", "city", "max_capacity_per_day"
    )


def stg_shipments(raw_shipments: DataFrame) -> DataFrame:
    return raw_shipments.select(
        "shipment_id",
        "sender_id",
        "origin_facility_id",
        "destination_facility_id",
        "weight_kg",
        "declared_value",
        "shipping_cost",
        F.col("created_at").cast("timestamp_ntz").alias("created_at_ts"),
        "estimated_delivery_date",
    )


def stg_tracking_events(raw_tracking_events: DataFrame) -> DataFrame:
    """ISO text -> ``timestamp_ntz``; under ANSI mode a malformed value fails the job."""
    return raw_tracking_events.select(
        "event_id",
        "shipment_id",
        "status_code",
        "facility_id",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp_ts"),
        "courier_notes",
        "source_file",
    )


def stg_weather_delays(raw_weather: DataFrame) -> DataFrame:
    return raw_weather.select(
        F.col("date").alias("weather_date"),
        "city",
        "weather_condition",
        "precipitation_mm",
        "regional_delay_flag",
    )
