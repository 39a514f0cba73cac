"""Plan-shape regressions: bounded broadcasts, no pair-generating joins."""

import re

import pytest

import __spark_entry__ as E
from parcelspark.operators.joins import fits_broadcast
from parcelspark.plans import queries as Q
from parcelspark.session import CONF_BROADCAST_MAX_ROWS
from parcelspark.sources import fixtures
from tests.conftest import SF_SMALL

PAIR_JOINS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", sorted(Q.sql_queries()))
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = Q.sql_queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not PAIR_JOINS.search(plan), key


def test_broadcast_bound_is_checked(spark):
    fac = fixtures.raw_facilities(spark, SF_SMALL)
    n = fac.count()
    assert fits_broadcast(fac, n) and not fits_broadcast(fac, n - 1)


def test_broadcast_check_moves_no_rows_and_bounds_bytes(spark, monkeypatch):
    from parcelspark.operators import joins

    df = spark.range(1000).selectExpr("id", "repeat('x', 100) as t")
    assert joins.measured_size(df) == (1000, 1000 * 116)
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 100_000)
    assert not joins.fits_broadcast(df)
    assert joins.measured_size(df.limit(0)) == (0, 0)


def test_jdbc_split_options():
    from datetime import datetime

    from parcelspark.sources import oltp

    lo, hi = datetime(2024, 1, 1), datetime(2024, 2, 1, 3)
    assert oltp.split_options(lo, hi, 8) == {
        "partitionColumn": "created_at", "lowerBound": "2024-01-01 00:00:00",
        "upperBound": "2024-02-01 03:00:00", "numPartitions": "8"}
    assert oltp.split_options(None, None, 1) == {}
    with pytest.raises(ValueError):
        oltp.split_options(None, hi, 8)
    assert oltp.jdbc_options("jdbc:x")["preferTimestampNTZ"] == "true"
    assert "created_at > TIMESTAMP '2024-01-01" in oltp.shipment_bounds_query(lo)


def test_shuffle_join_fallback_gives_same_result(spark, duck):
    key = "mart_route_performance"
    expected = sorted(map(tuple, Q.sql_queries()[key](spark, SF_SMALL).collect()), key=str)
    old_auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(CONF_BROADCAST_MAX_ROWS, "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.sql_queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        got = sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.unset(CONF_BROADCAST_MAX_ROWS)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_auto)
    assert got == expected
    oracle = duck.execute(E.oracle_sql()[key]).fetchall()
    assert len(oracle) == len(got)


def test_dq_summary_fused_and_fallback_agree(spark):
    fused = sorted(map(tuple, Q.sql_queries()["dq_summary"](spark, SF_SMALL).collect()))
    spark.conf.set(CONF_BROADCAST_MAX_ROWS, "1")
    try:
        fallback = sorted(map(tuple, Q.sql_queries()["dq_summary"](spark, SF_SMALL).collect()))
    finally:
        spark.conf.unset(CONF_BROADCAST_MAX_ROWS)
    assert fused == fallback and len(fused) == 18


def test_exception_filter_reaches_the_scan(spark, tmpdir_path):
    from parcelspark.plans.graph import ModelGraph
    from parcelspark.sources import seed
    from parcelspark.sources.fixtures import RawTables

    fixtures.raw_tracking_events(spark, SF_SMALL).write.parquet(f"{tmpdir_path}/ev")
    raw = RawTables(fixtures.raw_facilities(spark, SF_SMALL), fixtures.raw_shipments(spark, SF_SMALL),
                    spark.read.parquet(f"{tmpdir_path}/ev"), None, seed.status_codes(spark))
    plan = ModelGraph(raw).get("mart_exceptions_analysis")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(status_code, \[60,70,80\]\)", plan)
