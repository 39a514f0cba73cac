"""The five read-outs behind the reference's charts (drawing is left out).

Each returns a bounded result (a top-k, or one row per day / bracket /
exception type), so ``toPandas()`` on it is safe for plotting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions import expressions as X

TOP_K = 10


def report_daily_revenue(daily_revenue: DataFrame) -> DataFrame:
    return daily_revenue.select("shipment_date", "total_revenue").orderBy("shipment_date")


def report_top_routes(route_performance: DataFrame, k: int = TOP_K) -> DataFrame:
    """Busiest routes; ties broken by label then cities (NULLs last) so the
    cut is deterministic.  Plans as TakeOrderedAndProject (per-task top-k)."""
    return (
        route_performance.select(
            X.route_label(F.col("origin_city"), F.col("destination_city")).alias("route"),
            "total_shipments",
            "origin_city",
            "destination_city",
        )
        .orderBy(
            F.desc("total_shipments"),
            F.asc_nulls_last("route"),
            F.asc_nulls_last("origin_city"),
            F.asc_nulls_last("destination_city"),
        )
        .limit(k)
        .select("route", "total_shipments")
    )


def report_top_facilities(facility_traffic: DataFrame, k: int = TOP_K) -> DataFrame:
    return (
        facility_traffic.orderBy(
            F.desc("total_scans"), F.asc_nulls_last("facility_name"), F.asc("facility_id")
        )
        .limit(k)
        .select("facility_name", "total_scans")
    )


def report_exceptions_breakdown(exceptions: DataFrame) -> DataFrame:
    """Count per exception type and its share of all exceptions (percent).

    The total is a window over the *grouped* result, which has at most one
    row per status name of the seed (plus NULL): a bounded single-partition
    step after a partial-aggregated group-by.  (A scalar subquery would
    re-run the whole exceptions pipeline for the total.)
    """
    counts = exceptions.groupBy("exception_type").agg(F.count("event_id").alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy())
    return counts.select(
        "exception_type",
        "cnt",
        F.try_divide(F.col("cnt").cast("double") * F.lit(100.0), total.cast("double")).alias("share_pct"),
    )


def report_weight_pricing(weight_pricing: DataFrame) -> DataFrame:
    return weight_pricing.select("weight_bracket", "avg_cost_per_shipment")
