"""Marts from mergeable partial aggregates.

Each batch of events or shipments is reduced to partials and appended; a mart
merges all of them when it is read, so a batch costs its own size.  After
``MAX_PARTS`` batches the partials are merged into one (``compact``).

* traffic: scans per (facility, shipment) - the sum gives the scans, the number
  of pairs the distinct shipments;
* transit: per shipment the events, those with a time, the first and last time
  and whether any was an exception.  Gaps count minute boundaries between
  neighbours in time, so their sum is the boundaries between first and last,
  whatever the order the events arrive in;
* revenue: per day count, revenue and weight as exact decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import expressions as X
from parcelspark.functions import timeutil
from parcelspark.sinks import tables

MAX_PARTS = 24


def traffic_of(events: DataFrame) -> DataFrame:
    return events.where(F.col("facility_id").isNotNull()).groupBy("facility_id", "shipment_id").agg(
        F.count("event_id").alias("scans"))


def merged_traffic(parts: DataFrame) -> DataFrame:
    return parts.groupBy("facility_id", "shipment_id").agg(F.sum("scans").cast("long").alias("scans"))


def transit_of(events: DataFrame) -> DataFrame:
    """``events``: staged events with ``is_exception``."""
    return events.where(F.col("shipment_id").isNotNull()).groupBy("shipment_id").agg(
        F.count("event_id").alias("events"), F.count("event_timestamp_ts").alias("timed"),
        F.min("event_timestamp_ts").alias("first_ts"), F.max("event_timestamp_ts").alias("last_ts"),
        F.bool_or("is_exception").alias("had_exception"))


def merged_transit(parts: DataFrame) -> DataFrame:
    return parts.groupBy("shipment_id").agg(
        F.sum("events").cast("long").alias("events"), F.sum("timed").cast("long").alias("timed"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.bool_or("had_exception").alias("had_exception"))


def revenue_of(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy(F.to_date("created_at_ts").alias("shipment_date")).agg(
        F.count("shipment_id").alias("total_shipments"),
        X.money_sum(F.col("shipping_cost")).alias("total_revenue"), X.money_sum(F.col("weight_kg")).alias("total_weight_kg"))


def merged_revenue(parts: DataFrame) -> DataFrame:
    return parts.groupBy("shipment_date").agg(
        F.sum("total_shipments").cast("long").alias("total_shipments"),
        X.money_sum(F.col("total_revenue")).alias("total_revenue"), X.money_sum(F.col("total_weight_kg")).alias("total_weight_kg"))


MERGES = {"traffic": merged_traffic, "transit": merged_transit, "revenue": merged_revenue}


def add(spark: SparkSession, root: str, name: str, part: DataFrame) -> None:
    """Append a batch's partials; every ``MAX_PARTS`` batches they are merged."""
    path = f"{root}/{name}"
    tables.append(part, path, part.schema)
    if len(tables.data_paths(spark, path)) >= MAX_PARTS:
        tables.replace(MERGES[name](tables.read(spark, path)), path)


def merged(spark: SparkSession, root: str, name: str) -> DataFrame:
    return MERGES[name](tables.read(spark, f"{root}/{name}"))


def facility_traffic(traffic: DataFrame, stg_facilities: DataFrame) -> DataFrame:
    """``mart_facility_traffic`` from merged traffic."""
    per_facility = traffic.groupBy("facility_id").agg(
        F.sum("scans").alias("_scans"), F.count("shipment_id").alias("_shipments"))
    fac = stg_facilities.groupBy("facility_id", "facility_name", "city").agg(F.count(F.lit(1)).alias("_m"))
    return fac.join(per_facility, "facility_id", "left").select(
        "facility_id", "facility_name", "city",
        (F.coalesce("_scans", F.lit(0)) * F.col("_m")).cast("long").alias("total_scans"),
        F.coalesce("_shipments", F.lit(0)).cast("long").alias("unique_shipments_handled"))


def route_performance(transit: DataFrame, shipments_enriched: DataFrame) -> DataFrame:
    """``mart_route_performance`` from merged transit; shipment ids are unique."""
    minutes = F.when(F.col("timed") > 1, timeutil.minute_boundaries_between(F.col("first_ts"), F.col("last_ts")))
    per = transit.select("shipment_id", minutes.alias("_minutes"), "had_exception")
    return shipments_enriched.select("shipment_id", "origin_city", "destination_city").join(per, "shipment_id", "left").groupBy(
        "origin_city", "destination_city").agg(
        F.count("shipment_id").alias("total_shipments"),
        timeutil.mean_hours(F.sum("_minutes"), F.count("_minutes")).alias("avg_transit_hours"),
        F.sum(X.flag_to_int(F.col("had_exception"))).cast("long").alias("exception_count"))
