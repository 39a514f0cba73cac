"""Hand-made edge cases (semantic traps of the reference models)."""

from datetime import date, datetime
from decimal import Decimal

from parcelspark.plans.graph import ModelGraph
from tests import helpers as H

def graph(spark, **kw):
    return ModelGraph(H.raw(spark, **kw))


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_minute_boundary_counts_boundaries_not_elapsed(spark):
    g = graph(spark,
              ship=[H.shipment("s1")],
              ev=[H.event("e1", "s1", 10, "2024-01-01T00:00:59Z"),
                  H.event("e2", "s1", 20, "2024-01-01T00:01:01Z")])
    r = rows_by(g.get("int_tracking_with_lag"), "event_id")
    assert r["e1"]["previous_event_timestamp_ts"] is None
    assert r["e2"]["previous_event_timestamp_ts"] == datetime(2024, 1, 1, 0, 0, 59)
    assert r["e2"]["hours_since_last_event"] == 1 / 60.0


def test_single_and_no_event_lifecycle(spark):
    g = graph(spark,
              ship=[H.shipment("one"), H.shipment("none")],
              ev=[H.event("e1", "one", 10, "2024-01-01T01:00:00Z")])
    r = rows_by(g.get("mart_shipment_lifecycle"), "shipment_id")
    assert r["one"]["total_tracking_events"] == 1
    assert r["one"]["total_transit_time_hours"] is None
    assert r["one"]["had_exception"] is False
    assert r["none"]["total_tracking_events"] == 0
    assert r["none"]["total_transit_time_hours"] is None
    assert r["none"]["had_exception"] is None
    route = g.get("mart_route_performance").collect()
    assert len(route) == 1
    assert route[0]["total_shipments"] == 2
    assert route[0]["avg_transit_hours"] is None
    assert route[0]["exception_count"] == 0


def test_in_transit_scan_kept_in_exceptions_dropped_from_facility_marts(spark):
    g = graph(spark,
              ship=[H.shipment("s1")],
              ev=[H.event("e1", "s1", 80, "2024-01-01T01:00:00Z", facility=None)])
    assert [r["event_id"] for r in g.get("mart_exceptions_analysis").collect()] == ["e1"]
    traffic = rows_by(g.get("mart_facility_traffic"), "facility_id")
    assert traffic[1]["total_scans"] == 0 and traffic[2]["total_scans"] == 0
    assert g.get("mart_facility_capacity_utilization").count() == 0
    assert g.get("mart_daily_active_network").count() == 0


def test_orphan_event_and_unknown_status(spark):
    g = graph(spark,
              ship=[H.shipment("s1")],
              ev=[H.event("e1", "ghost", 60, "2024-01-01T01:00:00Z"),
                  H.event("e2", "s1", 99, "2024-01-01T01:00:00Z")])
    lag = rows_by(g.get("int_tracking_with_lag"), "event_id")
    assert set(lag) == {"e1", "e2"}
    assert lag["e2"]["status_name"] is None and lag["e2"]["is_exception"] is None
    assert g.get("mart_exceptions_analysis").count() == 0  # orphan dropped by the inner join
    life = rows_by(g.get("mart_shipment_lifecycle"), "shipment_id")
    assert set(life) == {"s1"}
    assert life["s1"]["had_exception"] is None  # only an unknown status


def test_two_deliveries_and_on_time_edges(spark):
    g = graph(spark,
              ship=[H.shipment("a", eta=date(2024, 1, 3)), H.shipment("b", eta=date(2024, 1, 3)),
                    H.shipment("c", eta=None)],
              ev=[H.event("e1", "a", 50, "2024-01-03T23:59:59Z"),
                  H.event("e2", "a", 50, "2024-01-04T00:00:00Z"),
                  H.event("e3", "b", 50, "2024-01-02T10:00:00Z"),
                  H.event("e4", "c", 50, "2024-01-02T10:00:00Z")])
    rows = g.get("mart_delivery_performance").collect()
    assert len(rows) == 4
    got = sorted((r["shipment_id"], str(r["actual_delivery_date"]), r["is_on_time"]) for r in rows)
    assert got == [("a", "2024-01-03", True), ("a", "2024-01-04", False),
                   ("b", "2024-01-02", True), ("c", "2024-01-02", False)]


def test_weight_bracket_edges(spark):
    g = graph(spark, ship=[H.shipment(str(i), weight=w) for i, w in
                           enumerate(["4.99", "5.00", "14.99", "15.00"])])
    r = rows_by(g.get("mart_weight_brackets_pricing"), "weight_bracket")
    assert r["Light (<5kg)"]["shipment_count"] == 1
    assert r["Medium (5-15kg)"]["shipment_count"] == 2
    assert r["Heavy (>15kg)"]["shipment_count"] == 1
    assert r["Heavy (>15kg)"]["avg_cost_per_shipment"] == 10.0


def test_same_name_facilities_merge_by_name_not_id(spark):
    fac = [(1, "Twin", "Regional", "Rome", 10), (2, "Twin", "Regional", "Rome", 10)]
    g = graph(spark, fac=fac,
              ship=[H.shipment("s1", origin=1, dest=2)],
              ev=[H.event("e1", "s1", 10, "2024-01-01T00:00:00Z", facility=1),
                  H.event("e2", "s1", 20, "2024-01-01T02:00:00Z", facility=2)])
    bott = g.get("mart_facility_bottlenecks").collect()
    assert len(bott) == 1 and bott[0]["avg_hours_delayed"] == 2.0
    cap = g.get("mart_facility_capacity_utilization").collect()
    assert len(cap) == 1 and cap[0]["daily_scans"] == 2 and cap[0]["utilization_pct"] == 20.0
    assert g.get("mart_facility_traffic").count() == 2


def test_repeated_facility_id_fan_out_matches_join_semantics(spark):
    # A duplicated dimension id doubles scans but not distinct shipments.
    fac = [(1, "Dup", "Regional", "Rome", 10), (1, "Dup", "Regional", "Rome", 10)]
    g = graph(spark, fac=fac, ship=[H.shipment("s1", origin=1, dest=1)],
              ev=[H.event("e1", "s1", 10, "2024-01-01T00:00:00Z", facility=1)])
    t = g.get("mart_facility_traffic").collect()
    assert len(t) == 1 and t[0]["total_scans"] == 2 and t[0]["unique_shipments_handled"] == 1


def test_city_without_facility_keeps_weather_row(spark):
    g = graph(spark,
              ship=[H.shipment("s1")],
              ev=[H.event("e1", "s1", 70, "2024-01-01T05:00:00Z", facility=1)],
              wx=[(date(2024, 1, 1), "Berlin", "Clear", 0.0, False),
                  (date(2024, 1, 1), "Nowhere", "Fog", 0.0, False),
                  (date(2024, 1, 2), "Berlin", "Clear", 0.0, False)])
    r = {(str(x["weather_date"]), x["city"]): x for x in g.get("mart_weather_impact").collect()}
    assert r[("2024-01-01", "Berlin")]["total_scans"] == 1
    assert r[("2024-01-01", "Berlin")]["exception_count"] == 1
    assert r[("2024-01-01", "Nowhere")]["total_scans"] == 0
    assert r[("2024-01-01", "Nowhere")]["exception_count"] == 0
    assert r[("2024-01-02", "Berlin")]["total_scans"] == 0


def test_tied_timestamps_order_by_event_id(spark):
    g = graph(spark, ship=[H.shipment("s1")],
              ev=[H.event("b", "s1", 20, "2024-01-01T00:00:00Z"),
                  H.event("a", "s1", 10, "2024-01-01T00:00:00Z"),
                  H.event("c", "s1", 30, "2024-01-01T00:10:00Z")])
    r = rows_by(g.get("int_tracking_with_lag"), "event_id")
    assert r["a"]["previous_event_timestamp_ts"] is None
    assert r["b"]["previous_event_timestamp_ts"] == datetime(2024, 1, 1)
    assert r["c"]["hours_since_last_event"] == 10 / 60.0


def test_money_and_type_contract(spark):
    g = graph(spark, ship=[H.shipment("s1", cost="10.10", weight="1.25"),
                           H.shipment("s2", cost="0.20", weight="2.50")])
    rev = g.get("mart_daily_revenue_summary")
    types = dict(rev.dtypes)
    assert types["total_revenue"] == "decimal(38,2)" and types["total_weight_kg"] == "decimal(38,2)"
    row = rev.collect()[0]
    assert row["total_revenue"] == Decimal("10.30") and row["total_shipments"] == 2
    wb = dict(g.get("mart_weight_brackets_pricing").dtypes)
    assert wb["avg_cost_per_shipment"] == "double"
    cap = dict(graph(spark).get("mart_facility_capacity_utilization").dtypes)
    assert cap["utilization_pct"] == "double"


def test_route_label_is_null_propagating(spark):
    from pyspark.sql import functions as F

    from parcelspark.functions.expressions import route_label

    df = spark.createDataFrame([("A", "B"), (None, "B")], "o string, d string")
    got = [r[0] for r in df.select(route_label(F.col("o"), F.col("d"))).collect()]
    assert got == ["A -> B", None]


def test_bad_timestamp_fails_the_job(spark):
    import pytest

    g = graph(spark, ship=[H.shipment("s1")], ev=[H.event("e1", "s1", 10, "bad")])
    with pytest.raises(Exception):
        g.get("stg_tracking_events").collect()


def test_null_timestamps_sort_last_like_the_sql_engine(spark):
    import duckdb

    evs = [H.event("a", "s1", 10, "2024-01-01T00:00:00Z"), H.event("b", "s1", 20, None),
           H.event("c", "s1", 30, "2024-01-01T03:00:00Z"), H.event("d", "s1", 40, None),
           H.event("e", "s2", 10, None)]
    g = graph(spark, ship=[H.shipment("s1"), H.shipment("s2")], ev=evs)
    got = sorted((r["event_id"], r["previous_event_timestamp_ts"], r["hours_since_last_event"])
                 for r in g.get("int_tracking_with_lag").collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t (event_id VARCHAR, shipment_id VARCHAR, ts TIMESTAMP)")
    con.executemany("INSERT INTO t VALUES (?, ?, CAST(? AS TIMESTAMP))", [(e[0], e[1], e[4]) for e in evs])
    exp = sorted(con.execute("""
        SELECT event_id, prev, CAST(date_diff('minute', prev, ts) AS DOUBLE) / 60.0 FROM (
          SELECT event_id, ts, lag(ts) OVER (PARTITION BY shipment_id ORDER BY ts, event_id) AS prev FROM t)
    """).fetchall())
    assert got == exp
