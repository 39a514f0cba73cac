"""Models maintained batch by batch, late shipments, certified joins, bucketed tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelspark.operators import intermediate as I
from parcelspark.operators import partials
from parcelspark.operators.lag_table import LagTable
from parcelspark.operators.joins import bounded_broadcast
from parcelspark.plans.graph import ModelGraph
from parcelspark.plans.roundtrips import bucketed_graph
from parcelspark.sinks import tables
from parcelspark.sinks.hourly_json import EXPORT_GLOB, export_hourly_json
from parcelspark.sources import fixtures
from parcelspark.streaming import late_exceptions
from tests import helpers as H
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lag_table_over_unordered_batches(spark, tmpdir_path):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    rows = [(f"e{i:04d}", rng.choice(["a", "b", "c", None]), start + timedelta(minutes=rng.randint(0, 300))) for i in range(300)]
    rows = [(i, k, None if k == "b" and rng.random() < 0.2 else ts) for i, k, ts in rows]  # without a time: last
    rng.shuffle(rows)
    rows.sort(key=lambda r: 0 if rng.random() < 0.6 else 1)
    table = LagTable(spark, f"{tmpdir_path}/lag", "k", "ts", "id", "prev", buckets=4)
    schema = "id string, k string, ts timestamp_ntz"
    repaired = 0
    for i in range(0, 300, 75):
        repaired += table.apply(spark.createDataFrame(rows[i : i + 75], schema))["repaired_buckets"]
    later = [(f"z{i}", "a", datetime(2025, 1, 1 + i)) for i in range(3)]
    parts = len(table._state()["parts"])
    assert repaired and table.apply(spark.createDataFrame(later, schema)) == {"repaired_buckets": 0}  # in order: nothing read
    assert len(table._state()["parts"]) == parts + 1
    far = datetime(9999, 1, 1)
    want, last = {}, {}
    for i, k, ts in sorted([*rows, *later], key=lambda r: (r[2] is None, r[2] or far, r[0])):
        want[i] = (k, ts, last.get(k))
        last[k] = ts
    assert {r.id: (r.k, r.ts, r.prev) for r in table.read().collect()} == want


def test_partials_merge_after_many_batches(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(partials, "MAX_PARTS", 3)
    ev = [H.event(f"e{i}", f"s{i % 3}", 10, f"2024-01-01T00:{i:02d}:30Z", facility=1 + i % 2) for i in range(12)]
    raw = H.raw(spark, ship=[H.shipment(f"s{i}") for i in range(3)], ev=ev)
    g = ModelGraph(raw)
    for k in range(6):
        part = g.get("tracking_with_status").where(F.col("event_id").substr(2, 9).cast("int") % 6 == k)
        partials.add(spark, tmpdir_path, "traffic", partials.traffic_of(part))
        partials.add(spark, tmpdir_path, "transit", partials.transit_of(part))
    assert len(tables.data_paths(spark, f"{tmpdir_path}/traffic")) < 3
    got = partials.facility_traffic(partials.merged(spark, tmpdir_path, "traffic"), g.get("stg_facilities"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, g.get("mart_facility_traffic").collect()))
    got = partials.route_performance(partials.merged(spark, tmpdir_path, "transit"), g.get("int_shipments_enriched"))
    assert list(map(tuple, got.collect())) == list(map(tuple, g.get("mart_route_performance").collect()))


def test_late_shipments_and_replayed_batches(spark, tmpdir_path, monkeypatch):
    ev = [H.event(f"e{i}", f"s{i % 4}", 90 if i % 2 else 10, f"2024-01-01T0{i}:00:00Z")[:6] for i in range(8)]
    codes = ModelGraph(H.raw(spark)).get("status_codes_mapping")
    bad = codes.where("is_exception").first().status_code
    ev = [(e, s, bad if st == 90 else st, f, t, n) for e, s, st, f, t, n in ev]
    events = H.events(spark, [(*e, "x") for e in ev])
    export_hourly_json(events, f"{tmpdir_path}/feed")
    known = [H.shipment("s1")]
    enriched = lambda: ModelGraph(H.raw(spark, ship=known)).get("int_shipments_enriched")
    root = f"{tmpdir_path}/late"
    ids = lambda: sorted(r.event_id for r in late_exceptions.read_feed(spark, root).collect())
    real, steps = late_exceptions.swap_file, []

    def dies(*args):
        steps.append(1)
        if len(steps) == 3:
            raise RuntimeError("lost")
        real(*args)

    monkeypatch.setattr(late_exceptions, "swap_file", dies)
    with pytest.raises(Exception, match="lost"):
        late_exceptions.drain(spark, f"{tmpdir_path}/feed", enriched, codes, root, EXPORT_GLOB, 2)
    late_exceptions.drain(spark, f"{tmpdir_path}/feed", enriched, codes, root, EXPORT_GLOB, 2)
    assert ids() == ["e1", "e5"] and late_exceptions.read_pending(spark, root).count() == 2
    late_exceptions.flush(spark, enriched, root)
    assert ids() == ["e1", "e5"]
    known.append(H.shipment("s3"))
    late_exceptions.flush(spark, enriched, root)
    late_exceptions.flush(spark, enriched, root)
    assert ids() == ["e1", "e3", "e5", "e7"] and late_exceptions.read_pending(spark, root).count() == 0


def test_joins_go_only_with_the_certificate(spark):
    ship = [H.shipment(f"s{i}", origin=1 + i % 2, dest=2) for i in range(4)]
    models = ("mart_daily_revenue_summary", "mart_weight_brackets_pricing", "mart_delivery_performance")
    g = ModelGraph(H.raw(spark, ship=ship))
    for name in models[:2]:
        assert "Join" not in plan_of(g.get(name))
    dup = ModelGraph(H.raw(spark, fac=[*H.DEFAULT_FACILITIES, H.DEFAULT_FACILITIES[1]], ship=ship))
    assert not I.facility_ids_unique(dup.get("stg_facilities"))
    for name in models[:2]:
        assert "Join" in plan_of(dup.get(name))
    # Facility 2 twice: every destination doubles a row, an origin too.
    assert g.get(models[0]).first().total_shipments == 4
    assert dup.get(models[0]).first().total_shipments == 2 * 2 + 2 * 4


def test_bucketed_tables_need_no_shuffle_on_the_shipment(spark):
    raw = fixtures.load_raw(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it runs
    try:
        plain, stored = (plan_of(g.get("mart_route_performance")) for g in (ModelGraph(raw), bucketed_graph(raw)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert "hashpartitioning(shipment_id" in plain
    assert "hashpartitioning(shipment_id" not in stored and "Bucketed: true" in stored
    assert "hashpartitioning(origin_city" in stored


def test_a_large_status_table_is_not_broadcast(spark):
    big = spark.range(1_000_000).selectExpr(
        "cast(id as int) as status_code", "concat('name ', id) as status_name", "false as is_final_state", "id % 2 = 0 as is_exception")
    assert bounded_broadcast(big) is big
    ev = ModelGraph(H.raw(spark, ev=[H.event("e", "s", 4, "2024-01-01T00:00:00Z")])).get("stg_tracking_events")
    joined = I.tracking_with_status(ev, big)
    hints = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in hints.lower() and joined.first().status_name == "name 4"
