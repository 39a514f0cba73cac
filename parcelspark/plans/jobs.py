"""Refresh jobs (the hourly and daily cadences) over a parquet warehouse.

hourly: facilities (full) + shipments (incremental by high-water mark)
        -> new event files -> staging checks -> hourly-tagged marts
daily:  facilities + shipments (full) -> event full refresh -> weather
        -> all staging checks -> daily-tagged marts

Each step is a Spark job; tables are replaced and appended by one pointer swap
(``sinks/tables.py``), events come through a file stream
(``streaming/event_table.py``); counts are observed during the write (no second pass).  The staging checks run before any mart is written and
raise ``QualityGateError`` on a violation.  Models shared by several marts
(the lag model, the shipment lifecycle) are written once and re-read,
which also cuts their lineage; every written mart is re-read by the marts
built on it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark import schemas
from parcelspark.functions.timeutil import ntz_literal
from parcelspark.operators import quality as Q
from parcelspark.operators.staging import stg_tracking_events
from parcelspark.plans.graph import DAILY, HOURLY, MODELS, ModelGraph, select_by_tag, topo_order
from parcelspark.sinks import tables
from parcelspark.sources import oltp, seed, tracking_json, weather_csv
from parcelspark.sources.fixtures import RawTables
from parcelspark.sources.fs import path_exists
from parcelspark.streaming import event_table

SHARED_MODELS = ("tracking_lag_full", "shipment_lifecycle_full")


@dataclass
class Warehouse:
    root: str

    def raw(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/raw/{name}"

    def model(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/models/{name}"


@dataclass
class JobConfig:
    warehouse: Warehouse
    read_facilities: Callable[[SparkSession], DataFrame]
    read_shipments: Callable[[SparkSession, datetime | None], DataFrame]
    events_dir: str
    weather_path: str | None = None
    events_glob: str = tracking_json.EVENT_FILE_GLOB
    events_recursive: bool = False
    max_files: int | None = None  # event files in a micro-batch
    gate: bool = True
    stats: dict = field(default_factory=dict)


# ------------------------------------------------------------------ extract
def extract_oltp(spark: SparkSession, cfg: JobConfig, incremental: bool) -> dict:
    """Facilities are replaced; shipments after the high-water mark are
    appended, or replaced too when there is no mark yet."""
    facilities, shipments = cfg.warehouse.raw("facilities"), cfg.warehouse.raw("shipments")
    mark = oltp.high_water_mark(spark, shipments) if incremental else None
    loaded = {"facilities_loaded": tables.replace(oltp.project_facilities(cfg.read_facilities(spark)), facilities)}
    rows = oltp.project_shipments(cfg.read_shipments(spark, mark), mark)
    if mark is None:
        return loaded | {"mode": "full", "since": None, "shipments_loaded": tables.replace(rows, shipments)}
    added = tables.append(rows, shipments, schemas.SHIPMENTS)
    return loaded | {"mode": "incremental", "since": str(mark), "shipments_loaded": added}


def extract_events(spark: SparkSession, cfg: JobConfig, full_refresh: bool) -> dict:
    wh = cfg.warehouse
    return event_table.ingest_new_files(
        spark, cfg.events_dir, wh.raw("tracking_events"), wh.raw("_ingested_files"),
        full_refresh=full_refresh, glob=cfg.events_glob, recursive=cfg.events_recursive, max_files=cfg.max_files,
    )


def extract_weather(spark: SparkSession, cfg: JobConfig) -> dict:
    if not cfg.weather_path:
        raise weather_csv.SourceMissingError("no weather source configured")
    df = weather_csv.read_weather_csv(spark, cfg.weather_path)
    n = tables.replace(df, cfg.warehouse.raw("historical_weather_delays"))
    return {"weather_rows_loaded": n, "source_object": cfg.weather_path}


# ------------------------------------------------------------------- models
def warehouse_raw(spark: SparkSession, wh: Warehouse, with_weather: bool) -> RawTables:
    weather = None
    if with_weather:
        weather = tables.read(spark, wh.raw("historical_weather_delays"))
    events = event_table.read_events_table(spark, wh.raw("tracking_events"), wh.raw("_ingested_files"))
    return RawTables(
        facilities=tables.read(spark, wh.raw("facilities")),
        shipments=tables.read(spark, wh.raw("shipments")),
        tracking_events=events,
        weather=weather,
        status_codes=seed.status_codes(spark),
    )


GATE_LOG_SCHEMA = T.StructType([
    T.StructField("run_at", T.TimestampNTZType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("shipments_mark", T.TimestampNTZType(), True),
    T.StructField("generation", T.LongType(), True),
    T.StructField("batches", T.ArrayType(T.StringType()), True),
])


def last_gate(spark: SparkSession, wh: Warehouse) -> dict | None:
    path = wh.raw("_gate_log")
    if not path_exists(spark, path):
        return None
    row = spark.read.schema(GATE_LOG_SCHEMA).parquet(path).orderBy(F.desc("run_at")).first()
    return row.asDict() if row else None


def run_checks(spark: SparkSession, cfg: JobConfig, graph: ModelGraph, tag: str) -> tuple[str, list[dict]]:
    """Staging assertions before any mart is written; the outcome and the
    validated state are appended to a gate log.

    The hourly gate is incremental when the last gate passed on the same
    ledger generation: rows beyond that validated state (shipments after
    its mark, event batches it did not see - including those of a run that
    died before its gate) are the new rows.  Anything else runs the full
    suite.  Either way the result rows are the same assertions.
    """
    wh = cfg.warehouse
    with_weather = tag == DAILY
    ledger = wh.raw("_ingested_files")
    generation, batches = event_table.committed_batches(spark, ledger)
    mark = oltp.high_water_mark(spark, wh.raw("shipments"))
    last = last_gate(spark, wh)
    incremental = (
        tag == HOURLY and last is not None and last["passed"]
        and last["generation"] == generation and set(last["batches"] or []) <= set(batches)
    )
    fac, ship, ev = graph.get("stg_facilities"), graph.get("stg_shipments"), graph.get("stg_tracking_events")
    if incremental:
        new_batches = sorted(set(batches) - set(last["batches"] or []))
        new_ev = stg_tracking_events(event_table.read_event_batches(
            spark, wh.raw("tracking_events"), generation, new_batches))
        new_ship = ship if last["shipments_mark"] is None else ship.where(
            F.col("created_at_ts") > ntz_literal(last["shipments_mark"])
        )
        summary = Q.dq_summary_incremental(fac, ship, new_ship, ev, new_ev, graph.get("status_codes_mapping"))
    else:
        summary = Q.dq_summary(
            fac, ship, ev, graph.get("stg_weather_delays") if with_weather else None,
            graph.get("status_codes_mapping"),
        )
    rows = [r.asDict() for r in summary.collect()]  # 15 or 18 rows
    passed = not any(r["failures"] for r in rows)
    mode = "incremental" if incremental else "full"
    spark.createDataFrame(
        [(datetime.now(timezone.utc).replace(tzinfo=None), tag, mode, passed, mark, generation, batches)],
        GATE_LOG_SCHEMA,
    ).write.mode("append").parquet(wh.raw("_gate_log"))
    Q.raise_on_failures(rows)
    return mode, rows


def build_models(spark: SparkSession, cfg: JobConfig, tag: str) -> dict:
    wh = cfg.warehouse
    with_weather = tag == DAILY
    graph = ModelGraph(warehouse_raw(spark, wh, with_weather))
    gate_mode, checks = run_checks(spark, cfg, graph, tag) if cfg.gate else ("off", [])
    targets = select_by_tag(tag)
    order = topo_order(targets)
    needed = set(order)
    written: dict[str, str] = {}
    for name in order:
        kind = MODELS[name].kind
        if name in SHARED_MODELS and name in needed:
            consumers = [t for t in order if name in MODELS[t].deps]
            if len(consumers) < 2:
                continue
        elif kind != "table":
            continue
        tables.replace(graph.get(name), wh.model(name))
        graph.set(name, tables.read(spark, wh.model(name)))
        (written[name],) = tables.data_paths(spark, wh.model(name))
    return {"tag": tag, "checks": len(checks), "gate_mode": gate_mode, "written": written}


# --------------------------------------------------------------------- jobs
def refresh_hourly(spark: SparkSession, cfg: JobConfig) -> dict:
    stats = {
        "oltp": extract_oltp(spark, cfg, incremental=True),
        "events": extract_events(spark, cfg, full_refresh=False),
    }
    stats["models"] = build_models(spark, cfg, HOURLY)
    return stats


def refresh_daily(spark: SparkSession, cfg: JobConfig) -> dict:
    stats = {
        "oltp": extract_oltp(spark, cfg, incremental=False),
        "events": extract_events(spark, cfg, full_refresh=True),
        "weather": extract_weather(spark, cfg),
    }
    stats["models"] = build_models(spark, cfg, DAILY)
    # generations superseded by the new one, past the grace period
    stats["vacuumed_generations"] = event_table.vacuum(
        spark, cfg.warehouse.raw("tracking_events"), cfg.warehouse.raw("_ingested_files")
    )
    return stats
