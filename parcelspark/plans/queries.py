"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query derives its input from the driver's tables through the fixture
adapter, over whole tables.  Each key here has an oracle statement in
``parcelspark.plans.oracle``; the file/stream round trips live in
``parcelspark.plans.roundtrips``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions import timeutil
from parcelspark.operators import quality as Q
from parcelspark.operators.lag import lag_by_key
from parcelspark.plans.graph import MART_NAMES, REPORT_NAMES, ModelGraph
from parcelspark.sources import fixtures, oltp

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters of the incremental-scan and new-file queries (a previous load's
# high-water mark and the ledger cut-off of an earlier ingest run).
INCREMENTAL_SINCE = datetime(2024, 1, 25, 0, 0, 0)
LEDGER_CUTOFF = datetime(2024, 1, 15, 0, 0, 0)


def graph(spark: SparkSession, sf_dir: str) -> ModelGraph:
    return ModelGraph(fixtures.load_raw(spark, sf_dir))


def _model(name: str) -> QueryFn:
    return lambda spark, sf_dir: graph(spark, sf_dir).get(name)


# ----------------------------------------------------------------- sources
def scan_facilities(spark, sf_dir):
    return oltp.project_facilities(fixtures.raw_facilities(spark, sf_dir))


def scan_shipments(spark, sf_dir):
    return oltp.project_shipments(fixtures.raw_shipments(spark, sf_dir))


def scan_shipments_incremental(spark, sf_dir):
    return oltp.project_shipments(fixtures.raw_shipments(spark, sf_dir), since=INCREMENTAL_SINCE)


def shipments_high_water_mark(spark, sf_dir):
    return oltp.high_water_mark_frame(fixtures.raw_shipments(spark, sf_dir))


def hub_facilities(spark, sf_dir):
    return oltp.hub_facilities(fixtures.raw_facilities(spark, sf_dir))


def shipments_ordered(spark, sf_dir):
    return oltp.shipments_by_creation(fixtures.raw_shipments(spark, sf_dir))


def new_files_antijoin(spark, sf_dir):
    """Files seen in the feed minus files recorded by an earlier ingest run."""
    from parcelspark.sources.tracking_json import new_files

    ev = fixtures.raw_tracking_events(spark, sf_dir)
    listing = ev.select(F.col("source_file").alias("file_name")).distinct()
    ledger = (
        ev.where(F.col("event_timestamp").cast("timestamp_ntz") < timeutil.ntz_literal(LEDGER_CUTOFF))
        .select(F.col("source_file").alias("file_name"))
        .distinct()
    )
    return new_files(listing, ledger)


# ------------------------------------------------------------ scalar rules
def event_hour_bucket(spark, sf_dir):
    ev = fixtures.raw_tracking_events(spark, sf_dir)
    return ev.groupBy(timeutil.hour_bucket_from_text(F.col("event_timestamp")).alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


# Low enough that busy facilities, and the events without one, count as hot.
HOT_ROWS_PER_TASK = 200


def int_tracking_with_lag_hot(spark, sf_dir):
    """The split path of the skew-aware lag: previous event at the same facility (or at none)."""
    t = graph(spark, sf_dir).get("stg_tracking_events").select("event_id", "facility_id", "event_timestamp_ts")
    return lag_by_key(t, "facility_id", ["event_timestamp_ts", "event_id"], "event_timestamp_ts", "previous_event_ts",
                      rows_per_task=HOT_ROWS_PER_TASK, sample_fraction=1.0)


# ------------------------------------------------------------ data quality
def _dq(fn_name: str) -> QueryFn:
    def run(spark, sf_dir):
        g = graph(spark, sf_dir)
        fac, ship, ev = g.get("stg_facilities"), g.get("stg_shipments"), g.get("stg_tracking_events")
        if fn_name == "dq_unique":
            return Q.dq_unique(fac, ship, ev)
        if fn_name == "dq_not_null":
            return Q.dq_not_null({
                "stg_facilities": fac, "stg_shipments": ship, "stg_tracking_events": ev,
                "stg_weather_delays": g.get("stg_weather_delays"),
            })
        if fn_name == "dq_accepted_values":
            return Q.dq_accepted_values(fac)
        if fn_name == "dq_rel_origin":
            return Q.dq_rel_origin(ship, fac)
        if fn_name == "dq_rel_destination":
            return Q.dq_rel_destination(ship, fac)
        if fn_name == "dq_rel_event_shipment":
            return Q.dq_rel_event_shipment(ev, ship)
        if fn_name == "dq_rel_event_status":
            return Q.dq_rel_event_status(ev, g.get("status_codes_mapping"))
        if fn_name == "dq_summary":
            return Q.dq_summary(fac, ship, ev, g.get("stg_weather_delays"), g.get("status_codes_mapping"))
        raise KeyError(fn_name)

    return run


# Violations planted by id, so that every assertion has rows to return.
UNKNOWN_TYPE, UNKNOWN_FACILITY, UNKNOWN_STATUS = "Depot", 999_999_999, 99


def planted(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The staging frames with duplicate ids, an unknown type and status, dangling destinations and shipments."""
    g = graph(spark, sf_dir)
    fac, ship, ev = g.get("stg_facilities"), g.get("stg_shipments"), g.get("stg_tracking_events")
    fac = fac.unionByName(fac.where("facility_id % 11 = 0")).withColumn(
        "facility_type", F.when(F.col("facility_id") % 7 == 0, F.lit(UNKNOWN_TYPE)).otherwise(F.col("facility_type")))
    sid, eid = F.col("shipment_id").cast("long"), F.col("event_id").cast("long")
    ship = ship.unionByName(ship.where(sid % 13 == 0)).withColumn(
        "destination_facility_id",
        F.when(sid % 17 == 0, F.lit(UNKNOWN_FACILITY).cast("long")).otherwise(F.col("destination_facility_id")))
    ev = ev.unionByName(ev.where(eid % 29 == 0)).withColumns({
        "shipment_id": F.when(eid % 19 == 0, F.concat(F.lit("missing-"), F.col("event_id"))).otherwise(F.col("shipment_id")),
        "status_code": F.when(eid % 23 == 0, F.lit(UNKNOWN_STATUS)).otherwise(F.col("status_code")),
    })
    return fac, ship, ev


PLANTED_DQ: dict[str, QueryFn] = {
    "dq_unique_planted": lambda s, d: Q.dq_unique(*planted(s, d)),
    "dq_accepted_values_planted": lambda s, d: Q.dq_accepted_values(planted(s, d)[0]),
    "dq_rel_destination_planted": lambda s, d: Q.dq_rel_destination(planted(s, d)[1], planted(s, d)[0]),
    "dq_rel_event_shipment_planted": lambda s, d: Q.dq_rel_event_shipment(planted(s, d)[2], planted(s, d)[1]),
    "dq_rel_event_status_planted": lambda s, d: Q.dq_rel_event_status(
        planted(s, d)[2], graph(s, d).get("status_codes_mapping")),
}

DQ_KEYS = [
    "dq_unique", "dq_not_null", "dq_accepted_values", "dq_rel_origin", "dq_rel_destination",
    "dq_rel_event_shipment", "dq_rel_event_status", "dq_summary",
]

MODEL_KEYS = [
    "stg_facilities", "stg_shipments", "stg_tracking_events", "stg_weather_delays",
    "int_shipments_enriched", "int_tracking_with_lag",
    *MART_NAMES, *REPORT_NAMES,
]


def sql_queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "scan_facilities": scan_facilities,
        "scan_shipments": scan_shipments,
        "scan_shipments_incremental": scan_shipments_incremental,
        "shipments_high_water_mark": shipments_high_water_mark,
        "hub_facilities": hub_facilities,
        "shipments_ordered": shipments_ordered,
        "new_files_antijoin": new_files_antijoin,
    }
    q.update({k: _model(k) for k in MODEL_KEYS})
    q.update({
        "event_hour_bucket": event_hour_bucket,
        "int_tracking_with_lag_hot": int_tracking_with_lag_hot,
    })
    q.update({k: _dq(k) for k in DQ_KEYS})
    q.update(PLANTED_DQ)
    return q


def all_queries() -> dict[str, QueryFn]:
    from parcelspark.plans import roundtrips

    q = sql_queries()
    q.update(roundtrips.ROUNDTRIP_QUERIES)
    return q
