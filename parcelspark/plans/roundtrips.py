"""File and stream round trips over data Spark derives from the given tables.

Each query exports the adapter's tracking events (or weather) to files under
the session's shared checkpoint root - hourly JSON arrays, a CSV object -
and reads them back through the production source/stream code.  Every key has
an oracle statement: the export must reproduce the raw table exactly, the
streams in several micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import schemas
from parcelspark.functions import timeutil
from parcelspark.operators import partials
from parcelspark.operators.intermediate import INT_TRACKING_WITH_LAG_COLUMNS
from parcelspark.operators.lag_table import LagTable
from parcelspark.operators.layout import store_bucketed
from parcelspark.plans.graph import ModelGraph
from parcelspark.session import scratch_dir
from parcelspark.sinks import tables
from parcelspark.sinks.hourly_json import EXPORT_GLOB, export_hourly_json
from parcelspark.sources import fixtures, oltp, tracking_json, weather_csv
from parcelspark.streaming import event_table
from parcelspark.streaming import exceptions as stream_exc
from parcelspark.streaming import ingest as stream_ingest
from parcelspark.streaming import late_exceptions

RECORDS = tracking_json.RECORD_COLUMNS
#: Small enough that every test table takes several micro-batches.
FILES_PER_TRIGGER = 40
FIRST_LOAD_UNTIL = "2024-01-16 00:00:00"


def _export(spark: SparkSession, sf_dir: str, **kw) -> str:
    out = scratch_dir(spark, "events-export")
    export_hourly_json(fixtures.raw_tracking_events(spark, sf_dir), out, **kw)
    return out


def scan_tracking_json(spark, sf_dir):
    return tracking_json.read_event_files(spark, _export(spark, sf_dir)).select(*RECORDS)


def json_schema_backfill(spark, sf_dir):
    """Records lack their NULL fields and carry an unknown one; the declared
    read schema must restore the former as NULL and drop the latter."""
    out = _export(spark, sf_dir, extra_fields={"producer_version": F.lit("v2")})
    return tracking_json.read_event_files(spark, out).select(*RECORDS)


def json_provenance(spark, sf_dir):
    df = tracking_json.read_event_files(spark, _export(spark, sf_dir))
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("event_count"))


def export_hourly_json_files(spark, sf_dir):
    """One row per hour: what its files hold, and whether they are in time order."""
    files = spark.read.option("pathGlobFilter", EXPORT_GLOB).text(_export(spark, sf_dir), wholetext=True)
    stamps = F.from_json("value", "array<struct<event_timestamp:string>>")["event_timestamp"]
    parts = files.select(
        F.substring(F.col("_metadata.file_name"), 8, 13).alias("hour_bucket"),
        F.col("_metadata.file_name").alias("name"), stamps.alias("t"),
    )
    per_hour = parts.groupBy("hour_bucket").agg(
        F.sum(F.size("t")).alias("row_count"),
        F.sort_array(F.collect_list(F.struct(
            "name", F.element_at("t", 1).alias("first"), F.element_at("t", -1).alias("last"),
            (F.sort_array("t") == F.col("t")).alias("ok")))).alias("f"),
    )
    # Time ranges of an hour's files, in name order, must follow each other.
    ends = F.flatten(F.transform("f", lambda f: F.array(f["first"], f["last"])))
    return per_hour.select(
        "hour_bucket", "row_count", F.array_min(ends).alias("first_ts"), F.array_max(ends).alias("last_ts"),
        (F.forall("f", lambda f: f["ok"]) & (F.sort_array(ends) == ends)).alias("is_sorted"),
    )


def scan_weather_csv(spark, sf_dir):
    path = scratch_dir(spark, "weather-csv") + "/" + weather_csv.WEATHER_OBJECT
    weather_csv.write_weather_csv(fixtures.raw_weather(spark, sf_dir), path)
    return weather_csv.read_weather_csv(spark, path)


def _warehouse_paths(spark):
    root = scratch_dir(spark, "warehouse")
    return f"{root}/raw/tracking_events", f"{root}/raw/_ingested_files"


def warehouse_shipments(spark, sf_dir):
    """A full load of the shipments up to a day, then an incremental one: the table must hold each once."""
    whole, path = fixtures.raw_shipments(spark, sf_dir), f"{scratch_dir(spark, 'warehouse')}/shipments"
    day = F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz")
    tables.replace(oltp.project_shipments(whole).where(F.col("created_at") <= day), path)
    mark = oltp.high_water_mark(spark, path)
    tables.append(oltp.project_shipments(whole, since=mark), path, schemas.SHIPMENTS)
    return tables.read(spark, path, schemas.SHIPMENTS)


def ingest_ledger(spark, sf_dir):
    out = _export(spark, sf_dir)
    events_t, ledger_t = _warehouse_paths(spark)
    event_table.ingest_new_files(spark, out, events_t, ledger_t)
    return event_table.current_ledger(spark, ledger_t).select("file_name", "row_count")


def full_refresh_events(spark, sf_dir):
    """Incremental load, then a full refresh: the table must hold each event once."""
    out = _export(spark, sf_dir)
    events_t, ledger_t = _warehouse_paths(spark)
    event_table.ingest_new_files(spark, out, events_t, ledger_t)
    event_table.ingest_new_files(spark, out, events_t, ledger_t, full_refresh=True)
    return event_table.read_events_table(spark, events_t, ledger_t).select(*RECORDS)


def _refreshed_between_drains(spark, sf_dir):
    """(events, ledger) tables: the early hours drained, a full refresh, then the hours that have come since."""
    events = fixtures.raw_tracking_events(spark, sf_dir)
    early = F.col("event_timestamp") < FIRST_LOAD_UNTIL[:10]
    out, (events_t, ledger_t) = scratch_dir(spark, "events-export"), _warehouse_paths(spark)
    export_hourly_json(events.where(early), out)
    for full_refresh in (False, True):
        event_table.ingest_new_files(spark, out, events_t, ledger_t, full_refresh, max_files=FILES_PER_TRIGGER)
    export_hourly_json(events.where(~early), out)
    event_table.ingest_new_files(spark, out, events_t, ledger_t, max_files=FILES_PER_TRIGGER)
    return events_t, ledger_t


def stream_full_refresh(spark, sf_dir):
    """Drain, full refresh, second drain, each in several micro-batches: the table must hold each event once."""
    return event_table.read_events_table(spark, *_refreshed_between_drains(spark, sf_dir)).select(*RECORDS)


def stream_ledger(spark, sf_dir):
    """The ledger the micro-batches wrote, after a full refresh between two drains."""
    return event_table.current_ledger(spark, _refreshed_between_drains(spark, sf_dir)[1]).select("file_name", "row_count")


def stream_ingest_events(spark, sf_dir):
    out = _export(spark, sf_dir)
    sink = scratch_dir(spark, "stream-events")
    stream_ingest.stream_ingest_events(
        spark, out, sink + "/data", sink + "/_checkpoint", max_files_per_trigger=FILES_PER_TRIGGER
    )
    return spark.read.parquet(sink + "/data").select(*RECORDS)


def stream_exceptions(spark, sf_dir):
    out = _export(spark, sf_dir)
    g = ModelGraph(fixtures.load_raw(spark, sf_dir))
    sink = scratch_dir(spark, "stream-exceptions")
    stream_exc.run_exceptions_feed(
        spark, out, g.get("int_shipments_enriched"), g.get("status_codes_mapping"),
        sink + "/data", sink + "/_checkpoint", EXPORT_GLOB, FILES_PER_TRIGGER,
    )
    return spark.read.parquet(sink + "/data")


def stream_exceptions_late(spark, sf_dir):
    """Events first, most of them before their shipments; the feed gets the rest when the shipments come."""
    out, g = _export(spark, sf_dir), ModelGraph(fixtures.load_raw(spark, sf_dir))
    whole, codes = g.get("int_shipments_enriched"), g.get("status_codes_mapping")
    early = whole.where(F.col("created_at_ts") <= F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz"))
    root = scratch_dir(spark, "late-exceptions")
    late_exceptions.drain(spark, out, lambda: early, codes, root, EXPORT_GLOB, FILES_PER_TRIGGER)
    late_exceptions.flush(spark, lambda: whole, root)
    return late_exceptions.read_feed(spark, root)


BATCHES = 3


def _batches(df: DataFrame, column: str) -> list[DataFrame]:
    """Three batches in no order of time."""
    part = F.pmod(F.xxhash64(column), F.lit(BATCHES))
    return [df.where(part == k) for k in range(BATCHES)]


def int_tracking_with_lag_incremental(spark, sf_dir):
    tracking = ModelGraph(fixtures.load_raw(spark, sf_dir)).get("tracking_with_status")
    table = LagTable(spark, scratch_dir(spark, "lag-table"), "shipment_id", "event_timestamp_ts", "event_id",
                     "previous_event_timestamp_ts")
    for batch in _batches(tracking, "event_id"):
        table.apply(batch)
    minutes = timeutil.minute_boundaries_between(F.col("previous_event_timestamp_ts"), F.col("event_timestamp_ts"))
    return table.read().withColumn("hours_since_last_event", timeutil.minutes_to_hours(minutes)).select(
        *INT_TRACKING_WITH_LAG_COLUMNS)


def _partials(spark, name: str, batches: list[DataFrame], reduce) -> DataFrame:
    root = scratch_dir(spark, "partials")
    for batch in batches:
        partials.add(spark, root, name, reduce(batch))
    return partials.merged(spark, root, name)


def mart_facility_traffic_incremental(spark, sf_dir):
    g = ModelGraph(fixtures.load_raw(spark, sf_dir))
    parts = _partials(spark, "traffic", _batches(g.get("stg_tracking_events"), "event_id"), partials.traffic_of)
    return partials.facility_traffic(parts, g.get("stg_facilities"))


def mart_route_performance_incremental(spark, sf_dir):
    g = ModelGraph(fixtures.load_raw(spark, sf_dir))
    parts = _partials(spark, "transit", _batches(g.get("tracking_with_status"), "event_id"), partials.transit_of)
    return partials.route_performance(parts, g.get("int_shipments_enriched"))


def mart_daily_revenue_summary_incremental(spark, sf_dir):
    shipments = ModelGraph(fixtures.load_raw(spark, sf_dir)).get("stg_shipments")
    return _partials(spark, "revenue", _batches(shipments, "shipment_id"), partials.revenue_of)


#: Buckets of the stored tables below; on a cluster a few per core.
BUCKETS = 16


def mart_shipment_lifecycle_bucketed(spark, sf_dir):
    """The lifecycle mart over events and shipments stored in buckets of the shipment id."""
    raw = fixtures.load_raw(spark, sf_dir)
    return bucketed_graph(raw).get("mart_shipment_lifecycle")


def bucketed_graph(raw: fixtures.RawTables) -> ModelGraph:
    g = ModelGraph(raw)
    return ModelGraph(raw, {
        name: store_bucketed(g.get(name), "shipment_id", BUCKETS) for name in ("stg_shipments", "stg_tracking_events")})


ROUNDTRIP_QUERIES = {
    "scan_tracking_json": scan_tracking_json,
    "json_schema_backfill": json_schema_backfill,
    "json_provenance": json_provenance,
    "export_hourly_json": export_hourly_json_files,
    "scan_weather_csv": scan_weather_csv,
    "warehouse_shipments": warehouse_shipments,
    "ingest_ledger": ingest_ledger,
    "full_refresh_events": full_refresh_events,
    "stream_full_refresh": stream_full_refresh,
    "stream_ledger": stream_ledger,
    "stream_ingest_events": stream_ingest_events,
    "stream_exceptions": stream_exceptions,
    "stream_exceptions_late": stream_exceptions_late,
    "int_tracking_with_lag_incremental": int_tracking_with_lag_incremental,
    "mart_facility_traffic_incremental": mart_facility_traffic_incremental,
    "mart_route_performance_incremental": mart_route_performance_incremental,
    "mart_daily_revenue_summary_incremental": mart_daily_revenue_summary_incremental,
    "mart_shipment_lifecycle_bucketed": mart_shipment_lifecycle_bucketed,
}
