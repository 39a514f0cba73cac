"""Every SQL-checkable registered query equals its DuckDB oracle (sf0.001)."""

import math
from decimal import Decimal

import pytest

import __spark_entry__ as E
from parcelspark.plans import oracle, queries
from tests.conftest import SF_SMALL

ORACLES = oracle.oracle_sql()
QUERIES = queries.all_queries()
SQL_KEYS = [k for k in QUERIES if k in ORACLES]
ROUNDTRIPS = {"scan_tracking_json", "json_schema_backfill", "json_provenance", "scan_weather_csv",
              "full_refresh_events", "stream_ingest_events", "stream_exceptions", "export_hourly_json", "ingest_ledger",
              "stream_full_refresh", "stream_ledger", "stream_exceptions_late", "int_tracking_with_lag_incremental",
              "mart_facility_traffic_incremental", "mart_route_performance_incremental",
              "mart_daily_revenue_summary_incremental", "mart_shipment_lifecycle_bucketed"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["origin_city", "destination_city", "total_shipments", "avg_transit_hours",
                          "exception_count"]
    assert df.count() == 110


@pytest.mark.parametrize("key", [k for k in SQL_KEYS if k not in ROUNDTRIPS])
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert _canon(df.columns, got) == _canon(ocols, exp)


@pytest.mark.parametrize("key", sorted(ROUNDTRIPS))
def test_roundtrip_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    assert _canon(df.columns, got) == _canon(ocols, res.fetchall())
