"""Command line for the jobs (any scheduler can call these).

    python -m parcelspark.cli refresh-hourly --warehouse W --events-dir E (--jdbc-url U | --oltp-parquet P)
    python -m parcelspark.cli refresh-daily  --warehouse W --events-dir E --weather-csv C ...
    python -m parcelspark.cli extract-oltp   --warehouse W [--incremental] ...
    python -m parcelspark.cli extract-events --warehouse W --events-dir E [--full-refresh]
    python -m parcelspark.cli extract-weather --warehouse W --weather-csv C
    python -m parcelspark.cli build --tag daily --warehouse W
    python -m parcelspark.cli reports --warehouse W      # the five read-outs, printed

Every command prints one JSON line of stats.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from parcelspark.plans import jobs
from parcelspark.plans.graph import DAILY, HOURLY, REPORT_NAMES, MODELS
from parcelspark.sinks import tables
from parcelspark.sources import oltp


def _oltp_readers(args):
    if args.jdbc_url:
        opts = oltp.jdbc_options(args.jdbc_url, args.jdbc_user, args.jdbc_password, args.jdbc_driver)

        def read_facilities(spark):
            return oltp.read_facilities_jdbc(spark, opts)

        def read_shipments(spark, since):
            return oltp.read_shipments_jdbc(spark, opts, since=since, num_partitions=args.jdbc_partitions)

    elif args.oltp_parquet:
        root = args.oltp_parquet.rstrip("/")

        def read_facilities(spark):
            return spark.read.parquet(f"{root}/facilities")

        def read_shipments(spark, since):
            return oltp.project_shipments(spark.read.parquet(f"{root}/shipments"), since)

    else:
        def read_facilities(spark):
            raise SystemExit("an OLTP source is required: --jdbc-url or --oltp-parquet")

        def read_shipments(spark, since):
            return read_facilities(spark)

    return read_facilities, read_shipments


def config(args) -> jobs.JobConfig:
    read_facilities, read_shipments = _oltp_readers(args)
    return jobs.JobConfig(
        warehouse=jobs.Warehouse(args.warehouse),
        read_facilities=read_facilities,
        read_shipments=read_shipments,
        events_dir=args.events_dir or "",
        weather_path=args.weather_csv,
        events_glob=args.events_glob,
        events_recursive=args.events_recursive,
        gate=not args.no_gate,
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="parcelspark")
    p.add_argument("command", choices=[
        "refresh-hourly", "refresh-daily", "extract-oltp", "extract-events", "extract-weather",
        "build", "reports",
    ])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--events-dir")
    p.add_argument("--events-glob", default="events_*.json")
    p.add_argument("--events-recursive", action="store_true")
    p.add_argument("--weather-csv")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-partitions", type=int, default=64)
    p.add_argument("--oltp-parquet")
    p.add_argument("--incremental", action="store_true")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--tag", choices=[HOURLY, DAILY], default=DAILY)
    p.add_argument("--no-gate", action="store_true")
    return p


def _reports(spark: SparkSession, wh: jobs.Warehouse) -> dict:
    out = {}
    for name in REPORT_NAMES:
        (dep,) = MODELS[name].deps
        df: DataFrame = MODELS[name].build(tables.read(spark, wh.model(dep)))
        # read-outs are bounded (top-k or one row per day / bracket / type)
        out[name] = [r.asDict() for r in df.collect()]
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    if spark is None:
        from parcelspark.session import build_session

        spark = build_session(app_name=f"parcelspark-{args.command}")
    cfg = config(args)
    cmd = args.command
    if cmd == "refresh-hourly":
        stats = jobs.refresh_hourly(spark, cfg)
    elif cmd == "refresh-daily":
        stats = jobs.refresh_daily(spark, cfg)
    elif cmd == "extract-oltp":
        stats = jobs.extract_oltp(spark, cfg, incremental=args.incremental)
    elif cmd == "extract-events":
        stats = jobs.extract_events(spark, cfg, full_refresh=args.full_refresh)
    elif cmd == "extract-weather":
        stats = jobs.extract_weather(spark, cfg)
    elif cmd == "build":
        stats = jobs.build_models(spark, cfg, args.tag)
    else:
        stats = _reports(spark, cfg.warehouse)
    print(json.dumps(stats, default=str))
    return stats


if __name__ == "__main__":
    main(sys.argv[1:])
