"""Adapter: the driver's TPC-H-like parquet tables -> the raw logistics tables.

Deterministic and expressible in plain SQL (the oracle runs the same rules
in DuckDB, see ``parcelspark/oracle.py``).  Everything is a narrow projection
of one big table plus one scalar subquery (``n`` = supplier count), so the
adapter adds no shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import timeutil
from parcelspark.sources import seed

# Fixed values of the adapter (see FIXTURES.md §2).
FACILITY_TYPE_BY_MOD3 = ["National Hub", "Regional", "Local Branch"]
STATUS_BY_EVENT_TYPE = {"signup": 10, "click": 20, "view": 30, "purchase": 50}
ERROR_STATUS_BY_MOD3 = [60, 70, 80]
COURIER_NOTE_BY_MOD12 = {
    4: "Customer not at home",
    5: "Signature collected",
    6: "Left at front desk",
    7: "Weather delay",
    8: "Weather delay",
}
WEATHER_CONDITIONS_BY_MOD8 = [
    "Clear", "Cloudy", "Light Rain", "Heavy Rain",
    "Thunderstorm", "Light Snow", "Heavy Snow", "Fog",
]
DELAY_CONDITIONS = ["Heavy Rain", "Heavy Snow", "Thunderstorm"]
DELAY_PRECIPITATION_MM = 10
SHIPMENT_EPOCH = "2024-01-01 00:00:00"
SHIPMENT_SPREAD_MINUTES = 43200


@dataclass
class RawTables:
    """The five raw inputs of the model graph.

    Each field is a DataFrame or a zero-argument callable returning one; the
    model graph resolves callables only when a model needs that input.
    """

    facilities: DataFrame | Callable[[], DataFrame]
    shipments: DataFrame | Callable[[], DataFrame]
    tracking_events: DataFrame | Callable[[], DataFrame]
    weather: DataFrame | Callable[[], DataFrame] | None
    status_codes: DataFrame | Callable[[], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str, cache: dict | None = None) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if cache is None:
        return spark.read.parquet(path)
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


def _supplier_count(spark: SparkSession, sf_dir: str, cache: dict | None = None):
    """Scalar subquery: evaluated once per query, no cross join."""
    return _read(spark, sf_dir, "supplier", cache).select(F.count(F.lit(1))).scalar()


def _pick(index, values) -> F.Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def raw_facilities(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    s = _read(spark, sf_dir, "supplier", cache)
    n = _read(spark, sf_dir, "nation", cache).select("n_nationkey", "n_name")
    return (
        s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner")
        .select(
            s["s_suppkey"].cast("long").alias("facility_id"),
            s["s_name"].alias("facility_name"),
            _pick(F.pmod(s["s_suppkey"], F.lit(3)), FACILITY_TYPE_BY_MOD3).alias("facility_type"),
            n["n_name"].alias("city"),
            (F.lit(2) + F.pmod(s["s_suppkey"], F.lit(5))).cast("long").alias("max_capacity_per_day"),
        )
    )


def raw_shipments(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    o = _read(spark, sf_dir, "orders", cache)
    n = _supplier_count(spark, sf_dir, cache)
    k = F.col("o_orderkey")
    weight_units = (k * 37) % 3000
    created_at = F.timestamp_add(
        "MINUTE", (k * 7919) % SHIPMENT_SPREAD_MINUTES, F.lit(SHIPMENT_EPOCH).cast("timestamp_ntz")
    )
    return o.select(
        k.cast("string").alias("shipment_id"),
        F.col("o_custkey").cast("long").alias("sender_id"),
        (k % (n + 1)).cast("long").alias("origin_facility_id"),
        ((k * 7 + 3) % n).cast("long").alias("destination_facility_id"),
        (weight_units / F.lit(100).cast("double")).cast("decimal(5,2)").alias("weight_kg"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("declared_value"),
        (F.lit(40) + weight_units * F.lit(0.15).cast("double")).cast("decimal(10,2)").alias("shipping_cost"),
        created_at.alias("created_at"),
        F.date_add(F.to_date(created_at), (F.lit(1) + k % 7).cast("int")).alias("estimated_delivery_date"),
    )


def raw_tracking_events(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    e_tab = _read(spark, sf_dir, "events", cache)
    n = _supplier_count(spark, sf_dir, cache)
    e = F.col("event_id")
    etype = F.col("event_type")
    status = None
    for name, code in STATUS_BY_EVENT_TYPE.items():
        status = F.when(etype == name, F.lit(code)) if status is None else status.when(etype == name, F.lit(code))
    status = status.when(etype == "error", _pick(e % 3, ERROR_STATUS_BY_MOD3))
    note = None
    for m, text in COURIER_NOTE_BY_MOD12.items():
        note = F.when(e % 12 == m, F.lit(text)) if note is None else note.when(e % 12 == m, F.lit(text))
    return e_tab.select(
        e.cast("string").alias("event_id"),
        F.expr("event_id div 5").cast("string").alias("shipment_id"),
        status.cast("int").alias("status_code"),
        F.when(e % 9 == 0, F.lit(None)).otherwise(e % n).cast("int").alias("facility_id"),
        timeutil.iso_utc_text(F.col("ts")).alias("event_timestamp"),
        note.alias("courier_notes"),
        timeutil.event_file_name(timeutil.hour_bucket(F.col("ts"))).alias("source_file"),
    )


def raw_weather(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    """One row per (event day, nation).

    This is a product of days and nations by definition.  The day list, a
    scalar array with at most one entry per calendar day of the history, is
    exploded next to each nation.
    """
    days = (
        _read(spark, sf_dir, "events", cache)
        .select(F.to_date("ts").alias("d"))
        .distinct()  # partial-aggregated map side: one row per day per task
        .agg(F.sort_array(F.collect_list("d")).alias("days"))
        .scalar()
    )
    nat = _read(spark, sf_dir, "nation", cache)
    w = nat.select("n_nationkey", "n_name", F.explode(days).alias("d"))
    cond = _pick(F.pmod(F.dayofmonth("d") + F.col("n_nationkey"), F.lit(8)), WEATHER_CONDITIONS_BY_MOD8)
    precip = F.pmod(F.dayofmonth("d") * 7 + F.col("n_nationkey") * 3, F.lit(40)).cast("double")
    return w.select(
        F.col("d").alias("date"),
        F.col("n_name").alias("city"),
        cond.alias("weather_condition"),
        precip.alias("precipitation_mm"),
        (cond.isin(DELAY_CONDITIONS) & (precip > F.lit(DELAY_PRECIPITATION_MM))).alias("regional_delay_flag"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """Lazy raw inputs: a table is read (and its file listing taken) only if
    a model asks for it, and at most once per graph."""
    cache: dict = {}
    return RawTables(
        facilities=lambda: raw_facilities(spark, sf_dir, cache),
        shipments=lambda: raw_shipments(spark, sf_dir, cache),
        tracking_events=lambda: raw_tracking_events(spark, sf_dir, cache),
        weather=lambda: raw_weather(spark, sf_dir, cache),
        status_codes=lambda: seed.status_codes(spark),
    )
