"""The 13 business tables (marts).

Shape rules used throughout:

* Facility-level marts aggregate the (large, possibly skewed) event side by
  ``facility_id`` *before* joining the facility dimension.  Partial
  aggregation absorbs a hot facility map-side; the join then sees one row per
  facility (and day).  Each formula is exact also when a facility id repeats
  in the dimension (join fan-out is reproduced by multiplicities / sums).
* The shipment lifecycle aggregates events per shipment first, then joins
  shipments 1:1 - a hot shipment never lands in one join task.
* Money sums are DECIMAL(38,2); averages of decimals and of hours are DOUBLE
  computed once from exact sums (order-independent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import expressions as X
from parcelspark.functions import timeutil
from parcelspark.operators.intermediate import MINUTES_COL
from parcelspark.operators.joins import bounded_broadcast, fits_broadcast

LIFECYCLE_COLUMNS = [
    "shipment_id", "origin_city", "destination_city", "weight_kg", "shipping_cost",
    "total_tracking_events", "total_transit_time_hours", "had_exception",
]


def _facility_dim(stg_facilities: DataFrame, *cols: str) -> DataFrame:
    return bounded_broadcast(stg_facilities.select("facility_id", *cols), source=stg_facilities)


def _scanned(tracking: DataFrame) -> DataFrame:
    """Events that happened at a facility (in-transit scans have none)."""
    return tracking.where(F.col("facility_id").isNotNull()).withColumn(
        "facility_id", F.col("facility_id").cast("long")
    )


# ---------------------------------------------------------------- daily marts
def mart_courier_issues_summary(tracking: DataFrame) -> DataFrame:
    return (
        tracking.where(F.col("courier_notes").isNotNull())
        .groupBy("courier_notes")
        .agg(F.count("event_id").alias("frequency_count"))
    )


def mart_daily_active_network(tracking: DataFrame) -> DataFrame:
    # count(distinct) plans as a two-level aggregate keyed by (day, facility)
    # first, so one busy day never collects all its events in one task.
    return (
        tracking.where(F.col("facility_id").isNotNull())
        .groupBy(F.to_date("event_timestamp_ts").alias("network_date"))
        .agg(F.count_distinct("facility_id").alias("active_facilities_count"))
    )


def mart_daily_revenue_summary(shipments_enriched: DataFrame) -> DataFrame:
    return shipments_enriched.groupBy(F.to_date("created_at_ts").alias("shipment_date")).agg(
        F.count("shipment_id").alias("total_shipments"),
        X.money_sum(F.col("shipping_cost")).alias("total_revenue"),
        X.money_sum(F.col("weight_kg")).alias("total_weight_kg"),
    )


def mart_delivery_performance(shipments_enriched: DataFrame, tracking: DataFrame) -> DataFrame:
    deliveries = tracking.where(F.col("status_code") == X.DELIVERED_STATUS).select(
        "shipment_id", F.to_date("event_timestamp_ts").alias("actual_delivery_date")
    )
    return (
        shipments_enriched.select("shipment_id", "estimated_delivery_date")
        .join(deliveries, "shipment_id", "inner")
        .select(
            "shipment_id",
            "estimated_delivery_date",
            "actual_delivery_date",
            X.on_time(F.col("actual_delivery_date"), F.col("estimated_delivery_date")).alias("is_on_time"),
        )
    )


def exception_codes(status_codes: DataFrame) -> list[int]:
    """Status codes flagged as exceptions, of a table that is small enough to broadcast."""
    return sorted(r["status_code"] for r in status_codes.where(F.col("is_exception")).collect())


def mart_exceptions_analysis(
    shipments_enriched: DataFrame, tracking_status: DataFrame, status_codes: DataFrame | None = None
) -> DataFrame:
    exc = tracking_status
    if status_codes is not None and fits_broadcast(status_codes):
        # Same rows as the flag filter (unknown codes get a NULL flag), but on
        # a scan column: Catalyst pushes it below the seed join into the scan.
        exc = exc.where(F.col("status_code").isin(exception_codes(status_codes)))
    exc = exc.where(F.col("is_exception") == F.lit(True))
    s = shipments_enriched.select("shipment_id", "origin_city", "destination_city", "declared_value")
    return exc.join(s, "shipment_id", "inner").select(
        "event_id",
        "shipment_id",
        "origin_city",
        "destination_city",
        F.col("status_name").alias("exception_type"),
        F.col("event_timestamp_ts").alias("exception_time"),
        "courier_notes",
        F.col("declared_value").alias("potential_financial_loss"),
    )


def mart_facility_bottlenecks(stg_facilities: DataFrame, tracking_lag: DataFrame) -> DataFrame:
    per_facility = (
        _scanned(tracking_lag)
        .where(F.col(MINUTES_COL).isNotNull())
        .groupBy("facility_id")
        .agg(F.sum(MINUTES_COL).alias("_min"), F.count(MINUTES_COL).alias("_n"))
    )
    fac = _facility_dim(stg_facilities, "facility_name", "city")
    return (
        per_facility.join(fac, "facility_id", "inner")
        .groupBy("facility_name", "city")
        .agg(timeutil.mean_hours(F.sum("_min"), F.sum("_n")).alias("avg_hours_delayed"))
    )


def mart_facility_capacity_utilization(stg_facilities: DataFrame, tracking: DataFrame) -> DataFrame:
    per_day = (
        _scanned(tracking)
        .groupBy("facility_id", F.to_date("event_timestamp_ts").alias("scan_date"))
        .agg(F.count("event_id").alias("_scans"))
    )
    fac = _facility_dim(stg_facilities, "facility_name", "city", "max_capacity_per_day")
    agg = (
        per_day.join(fac, "facility_id", "inner")
        .groupBy("facility_name", "city", "scan_date", "max_capacity_per_day")
        .agg(F.sum("_scans").alias("daily_scans"))
    )
    return agg.select(
        "facility_name",
        "city",
        "scan_date",
        "daily_scans",
        "max_capacity_per_day",
        F.try_divide(
            F.col("daily_scans").cast("double") * F.lit(100.0),
            F.col("max_capacity_per_day").cast("double"),
        ).alias("utilization_pct"),
    )


def mart_facility_traffic(stg_facilities: DataFrame, tracking: DataFrame) -> DataFrame:
    """Scans and distinct shipments per facility; facilities without scans
    keep a row with zeros.  A facility row repeated m times in the dimension
    sees every scan m times (left-join fan-out) but the same distinct set."""
    per_facility = (
        _scanned(tracking)
        .groupBy("facility_id")
        .agg(
            F.count("event_id").alias("_scans"),
            F.count_distinct("shipment_id").alias("_shipments"),
        )
    )
    fac = (
        stg_facilities.groupBy("facility_id", "facility_name", "city")
        .agg(F.count(F.lit(1)).alias("_m"))
    )
    return fac.join(per_facility, "facility_id", "left").select(
        "facility_id",
        "facility_name",
        "city",
        (F.coalesce(F.col("_scans"), F.lit(0)) * F.col("_m")).cast("long").alias("total_scans"),
        F.coalesce(F.col("_shipments"), F.lit(0)).cast("long").alias("unique_shipments_handled"),
    )


def mart_financial_exposure(exceptions: DataFrame) -> DataFrame:
    return (
        exceptions.where(F.col("exception_type").isin(X.FINANCIAL_EXCEPTION_TYPES))
        .groupBy("origin_city", "exception_type")
        .agg(
            F.count("shipment_id").alias("lost_or_damaged_count"),
            X.money_sum(F.col("potential_financial_loss")).alias("total_financial_exposure"),
        )
    )


def shipment_lifecycle(shipments_enriched: DataFrame, tracking_lag: DataFrame) -> DataFrame:
    """Lifecycle with the internal exact ``total_transit_minutes`` column."""
    per_shipment = tracking_lag.groupBy("shipment_id").agg(
        F.count("event_id").alias("_events"),
        F.sum(MINUTES_COL).alias("_minutes"),
        F.bool_or("is_exception").alias("_exc"),
    )
    keys = ["shipment_id", "origin_city", "destination_city", "weight_kg", "shipping_cost"]
    return (
        shipments_enriched.select(*keys)
        .join(per_shipment, "shipment_id", "left")
        # 1:1 for unique shipment ids; the group-by keeps the join fan-out
        # semantics for repeated ids and needs no extra shuffle (it is
        # clustered by shipment_id already).
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("_events"), F.lit(0)).cast("long").alias("total_tracking_events"),
            F.sum("_minutes").alias("total_transit_minutes"),
            F.bool_or("_exc").alias("had_exception"),
        )
        .withColumn(
            "total_transit_time_hours", timeutil.minutes_to_hours(F.col("total_transit_minutes"))
        )
    )


def mart_shipment_lifecycle(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.select(*LIFECYCLE_COLUMNS)


def mart_route_performance(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.groupBy("origin_city", "destination_city").agg(
        F.count("shipment_id").alias("total_shipments"),
        timeutil.mean_hours(
            F.sum("total_transit_minutes"), F.count("total_transit_minutes")
        ).alias("avg_transit_hours"),
        F.sum(X.flag_to_int(F.col("had_exception"))).cast("long").alias("exception_count"),
    )


def mart_weather_impact(
    stg_weather: DataFrame, stg_facilities: DataFrame, tracking_status: DataFrame
) -> DataFrame:
    """Scans and exceptions on the day of each city's weather record.

    Events are rolled up to (city, day) through the facility lookup first,
    then joined 1:1 to the weather rows; the weather x facility expansion of
    a city-level left join never materializes, and a city with very many
    facilities is not a skewed join key.  Repeated facility ids or weather
    rows still fan out exactly as the join formulation does.
    """
    per_day = (
        _scanned(tracking_status)
        .groupBy("facility_id", F.to_date("event_timestamp_ts").alias("_day"))
        .agg(
            F.count("event_id").alias("_scans"),
            F.sum(X.flag_to_int(F.col("is_exception"))).alias("_exc"),
        )
    )
    fac = _facility_dim(stg_facilities, "city")
    per_city_day = (
        per_day.join(fac, "facility_id", "inner")
        .groupBy(F.col("city").alias("_city"), "_day")
        .agg(F.sum("_scans").alias("_scans"), F.sum("_exc").alias("_exc"))
    )
    joined = stg_weather.join(
        per_city_day,
        (stg_weather["city"] == per_city_day["_city"]) & (stg_weather["weather_date"] == per_city_day["_day"]),
        "left",
    )
    return joined.groupBy("weather_date", "city", "weather_condition", "regional_delay_flag").agg(
        F.sum(F.coalesce(F.col("_scans"), F.lit(0))).cast("long").alias("total_scans"),
        F.sum(F.coalesce(F.col("_exc"), F.lit(0))).cast("long").alias("exception_count"),
    )


def mart_weight_brackets_pricing(shipments_enriched: DataFrame) -> DataFrame:
    return shipments_enriched.groupBy(X.weight_bracket(F.col("weight_kg")).alias("weight_bracket")).agg(
        F.count("shipment_id").alias("shipment_count"),
        X.decimal_mean_as_double(F.col("shipping_cost")).alias("avg_cost_per_shipment"),
    )
