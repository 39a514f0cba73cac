"""Intermediate models: enrichment joins (J1, J2) and the lag window (W1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import timeutil
from parcelspark.operators.joins import bounded_broadcast
from parcelspark.operators.lag import lag_by_key

INT_SHIPMENTS_ENRICHED_COLUMNS = [
    "shipment_id", "sender_id",
    "origin_facility_id", "origin_facility_name", "origin_city",
    "destination_facility_id", "destination_facility_name", "destination_city",
    "weight_kg", "declared_value", "shipping_cost", "created_at_ts", "estimated_delivery_date",
]

INT_TRACKING_WITH_LAG_COLUMNS = [
    "event_id", "shipment_id", "status_code", "status_name", "is_exception",
    "facility_id", "event_timestamp_ts", "courier_notes",
    "previous_event_timestamp_ts", "hours_since_last_event",
]

# Internal companion of hours_since_last_event: exact integer minutes, so that
# sums and means downstream are order-independent.
MINUTES_COL = "minutes_since_last_event"


def int_shipments_enriched(stg_shipments: DataFrame, stg_facilities: DataFrame) -> DataFrame:
    """Shipments with origin and destination facility names/cities (two left
    joins to the same dimension, broadcast behind a size check)."""
    fac = bounded_broadcast(stg_facilities.select("facility_id", "facility_name", "city"), source=stg_facilities)
    origin = fac.select(
        F.col("facility_id").alias("origin_facility_id"),
        F.col("facility_name").alias("origin_facility_name"),
        F.col("city").alias("origin_city"),
    )
    dest = fac.select(
        F.col("facility_id").alias("destination_facility_id"),
        F.col("facility_name").alias("destination_facility_name"),
        F.col("city").alias("destination_city"),
    )
    return (
        stg_shipments.join(origin, "origin_facility_id", "left")
        .join(dest, "destination_facility_id", "left")
        .select(*INT_SHIPMENTS_ENRICHED_COLUMNS)
    )


def facility_ids_unique(stg_facilities: DataFrame) -> bool:
    """Whether no facility id repeats (null ids join nothing): the certificate for leaving a join out."""
    repeated = stg_facilities.where("facility_id is not null").groupBy("facility_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.isEmpty()


def shipments_without_facilities(stg_shipments: DataFrame, stg_facilities: DataFrame) -> DataFrame:
    """``int_shipments_enriched`` for consumers that use no facility column.

    The two left joins change neither rows nor columns they see once facility
    ids are known to be unique; else the joins stay, with their fan-out.
    """
    if facility_ids_unique(stg_facilities):
        return stg_shipments
    return int_shipments_enriched(stg_shipments, stg_facilities)


def tracking_with_status(stg_tracking_events: DataFrame, status_codes: DataFrame) -> DataFrame:
    """Events with status name and exception flag (seed lookup, broadcast
    behind a size check)."""
    seed = bounded_broadcast(status_codes.select("status_code", "status_name", "is_exception"), source=status_codes)
    return stg_tracking_events.join(seed, "status_code", "left").select(
        "event_id", "shipment_id", "status_code", "status_name", "is_exception",
        "facility_id", "event_timestamp_ts", "courier_notes",
    )


def int_tracking_with_lag(tracking: DataFrame) -> DataFrame:
    """Previous event time per shipment and the gap in hours.

    Order is (event_timestamp_ts, event_id): the id breaks timestamp ties
    deterministically.  The gap counts minute boundaries crossed.
    Carries the internal ``minutes_since_last_event`` column.
    """
    lagged = lag_by_key(
        tracking,
        key="shipment_id",
        order_cols=["event_timestamp_ts", "event_id"],
        value_col="event_timestamp_ts",
        out_col="previous_event_timestamp_ts",
    )
    minutes = timeutil.minute_boundaries_between(
        F.col("previous_event_timestamp_ts"), F.col("event_timestamp_ts")
    )
    return lagged.select(
        "event_id", "shipment_id", "status_code", "status_name", "is_exception",
        "facility_id", "event_timestamp_ts", "courier_notes", "previous_event_timestamp_ts",
        timeutil.minutes_to_hours(minutes).alias("hours_since_last_event"),
        minutes.alias(MINUTES_COL),
    )


def published_tracking_with_lag(int_tracking: DataFrame) -> DataFrame:
    return int_tracking.select(*INT_TRACKING_WITH_LAG_COLUMNS)
