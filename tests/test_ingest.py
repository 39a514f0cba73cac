"""JSON event-file ingest, CSV weather, hourly export."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from parcelspark.sinks import tables
from parcelspark.sinks.hourly_json import export_hourly_json
from parcelspark.sources import fixtures, oltp, tracking_json, weather_csv
from parcelspark.sources.seed import STATUS_CODE_ROWS, read_status_codes_csv
from parcelspark.streaming import event_table
from parcelspark.streaming.ingest import stream_ingest_events
from tests.conftest import SF_SMALL


def _write(path, records):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(records, f, indent=2)


REC = {"event_id": "e1", "shipment_id": "s1", "status_code": 10, "facility_id": 3,
       "event_timestamp": "2024-01-01T00:00:00Z", "courier_notes": "Weather delay"}


@pytest.fixture()
def feed(tmpdir_path):
    d = os.path.join(tmpdir_path, "events")
    os.makedirs(d)
    _write(f"{d}/events_2024-01-01_00.json", [REC, dict(REC, event_id="e2", facility_id=None)])
    _write(f"{d}/events_2024-01-01_01.json", [])  # empty hour
    rec3 = {k: v for k, v in REC.items() if k != "courier_notes"}
    _write(f"{d}/events_2024-01-01_02.json", [dict(rec3, event_id="e3", extra_key="x")])
    _write(f"{d}/other.json", [dict(REC, event_id="zzz")])  # not an event file
    return tmpdir_path, d


def test_read_backfills_missing_drops_extra_and_tags_provenance(spark, feed):
    _, d = feed
    rows = {r["event_id"]: r for r in tracking_json.read_event_files(spark, d).collect()}
    assert set(rows) == {"e1", "e2", "e3"}
    assert rows["e3"]["courier_notes"] is None
    assert rows["e2"]["facility_id"] is None
    assert rows["e1"]["source_file"] == "events_2024-01-01_00.json"
    assert "extra_key" not in tracking_json.read_event_files(spark, d).columns


def test_ingest_is_incremental_by_file_name(spark, feed):
    root, d = feed
    ev_t, led_t = f"{root}/wh/events", f"{root}/wh/ledger"
    s1 = event_table.ingest_new_files(spark, d, ev_t, led_t)
    assert s1["files_loaded"] == 3 and s1["events_loaded"] == 3
    ledger = {r["file_name"]: r["row_count"] for r in event_table.current_ledger(spark, led_t).collect()}
    assert ledger == {"events_2024-01-01_00.json": 2, "events_2024-01-01_01.json": 0,
                      "events_2024-01-01_02.json": 1}
    # second run: nothing new; a file changed in place is not re-read
    _write(f"{d}/events_2024-01-01_00.json", [dict(REC, event_id="changed")])
    s2 = event_table.ingest_new_files(spark, d, ev_t, led_t)
    assert s2["files_loaded"] == 0
    _write(f"{d}/events_2024-01-01_03.json", [dict(REC, event_id="e4")])
    s3 = event_table.ingest_new_files(spark, d, ev_t, led_t)
    assert s3 == {"files_loaded": 1, "events_loaded": 1, "mode": "incremental"}
    ids = sorted(r["event_id"] for r in event_table.read_events_table(spark, ev_t, led_t).collect())
    assert ids == ["e1", "e2", "e3", "e4"]
    # full refresh reloads every file from scratch (changed content now seen)
    s4 = event_table.ingest_new_files(spark, d, ev_t, led_t, full_refresh=True)
    assert s4["files_loaded"] == 4
    ids = sorted(r["event_id"] for r in event_table.read_events_table(spark, ev_t, led_t).collect())
    assert ids == ["changed", "e3", "e4"]
    assert event_table.current_ledger(spark, led_t).count() == 4
    # an empty feed on full refresh commits an empty generation
    empty = f"{root}/empty"
    os.makedirs(empty)
    event_table.ingest_new_files(spark, empty, ev_t, led_t, full_refresh=True)
    assert event_table.read_events_table(spark, ev_t, led_t).count() == 0


def test_uncommitted_batch_is_invisible_and_run_again(spark, feed, monkeypatch):
    """A run that dies after writing events but before its ledger; one that dies before its checkpoint has it."""
    root, d = feed
    ev_t, led_t = f"{root}/wh2/events", f"{root}/wh2/ledger"
    event_table.ingest_new_files(spark, d, ev_t, led_t, max_files=2)
    want = {r["file_name"]: r["row_count"] for r in event_table.current_ledger(spark, led_t).collect()}
    _write(f"{d}/events_2024-01-01_07.json", [dict(REC, event_id="e7")])
    real = event_table._folder

    def dies(table, generation, batch=None):
        if table == led_t and batch == "000000002" and dies.armed and real(ev_t, 0, batch) in dies.seen:
            raise RuntimeError("lost")
        dies.seen.add(real(table, generation, batch))
        return real(table, generation, batch)

    dies.seen, dies.armed = set(), True
    monkeypatch.setattr(event_table, "_folder", dies)
    with pytest.raises(Exception, match="lost"):
        event_table.ingest_new_files(spark, d, ev_t, led_t)
    dies.armed = False
    assert os.path.isdir(real(ev_t, 0, "000000002")) and event_table.read_events_table(spark, ev_t, led_t).count() == 3
    assert event_table.ingest_new_files(spark, d, ev_t, led_t)["events_loaded"] == 1
    want["events_2024-01-01_07.json"] = 1
    # The last batch is run again: its commit is not in the checkpoint.
    commits = f"{led_t}/_checkpoints/_generation=0/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(f"{commits}/{name}")
    assert event_table.ingest_new_files(spark, d, ev_t, led_t)["files_loaded"] == 0
    assert {r["file_name"]: r["row_count"] for r in event_table.current_ledger(spark, led_t).collect()} == want
    assert sorted(r["event_id"] for r in event_table.read_events_table(spark, ev_t, led_t).collect()) == ["e1", "e2", "e3", "e7"]


def test_refresh_that_dies_before_the_swap_leaves_the_old_rows(spark, feed, monkeypatch):
    root, d = feed
    ev_t, led_t = f"{root}/wh4/events", f"{root}/wh4/ledger"
    event_table.ingest_new_files(spark, d, ev_t, led_t)
    _write(f"{d}/events_2024-01-01_00.json", [dict(REC, event_id="changed")])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(event_table, "swap_file", dies)
        with pytest.raises(RuntimeError, match="lost"):
            event_table.ingest_new_files(spark, d, ev_t, led_t, full_refresh=True)
    ids = lambda: sorted(r["event_id"] for r in event_table.read_events_table(spark, ev_t, led_t).collect())
    assert ids() == ["e1", "e2", "e3"]
    _write(f"{d}/events_2024-01-01_08.json", [dict(REC, event_id="e8")])
    assert event_table.ingest_new_files(spark, d, ev_t, led_t)["events_loaded"] == 1  # the old checkpoint goes on
    assert ids() == ["e1", "e2", "e3", "e8"]
    event_table.ingest_new_files(spark, d, ev_t, led_t, full_refresh=True)
    assert ids() == ["changed", "e3", "e8"] and event_table.current_generation(spark, led_t) == 2


def test_absent_events_dir_is_a_noop(spark, tmpdir_path):
    s = event_table.ingest_new_files(spark, f"{tmpdir_path}/missing", f"{tmpdir_path}/e", f"{tmpdir_path}/l")
    assert s["files_loaded"] == 0 and s["events_loaded"] == 0


def test_full_refresh_without_events_dir_empties_the_table(spark, feed):
    root, d = feed
    ev_t, led_t = f"{root}/wh9/events", f"{root}/wh9/ledger"
    event_table.ingest_new_files(spark, d, ev_t, led_t)
    event_table.ingest_new_files(spark, f"{root}/gone", ev_t, led_t)
    assert event_table.read_events_table(spark, ev_t, led_t).count() == 3
    s = event_table.ingest_new_files(spark, f"{root}/gone", ev_t, led_t, full_refresh=True)
    assert s == {"files_loaded": 0, "events_loaded": 0, "mode": "full_refresh"}
    assert event_table.read_events_table(spark, ev_t, led_t).count() == 0
    assert event_table.ingest_new_files(spark, d, ev_t, led_t)["events_loaded"] == 3


def test_stream_ingest_reads_each_file_once(spark, feed):
    root, d = feed
    sink, ck = f"{root}/stream/data", f"{root}/stream/ck"
    first = stream_ingest_events(spark, d, sink, ck)
    assert first["events_loaded"] == 3
    _write(f"{d}/events_2024-01-01_00.json", [dict(REC, event_id="changed")])  # same name
    _write(f"{d}/events_2024-01-01_05.json", [dict(REC, event_id="e5")])
    second = stream_ingest_events(spark, d, sink, ck)
    assert second["events_loaded"] == 1
    ids = sorted(r["event_id"] for r in spark.read.parquet(sink).collect())
    assert ids == ["e1", "e2", "e3", "e5"]


def test_malformed_file_fails(spark, tmpdir_path):
    d = f"{tmpdir_path}/bad"
    os.makedirs(d)
    with open(f"{d}/events_2024-01-01_00.json", "w") as f:
        f.write("[{\"event_id\": ")
    with pytest.raises(Exception):
        tracking_json.read_event_files(spark, d).collect()


def test_export_writes_sorted_json_arrays_and_splits_hot_hours(spark, tmpdir_path):
    ev = fixtures.raw_tracking_events(spark, SF_SMALL)
    hours = ev.select(F.substring("event_timestamp", 1, 13)).distinct().count()
    for rows_per_file in (None, 1):
        out = f"{tmpdir_path}/export-{rows_per_file}"
        export_hourly_json(ev, out, rows_per_file=rows_per_file)
        files = sorted(glob.glob(f"{out}/events_*.json"))
        assert sorted(glob.glob(f"{out}/*")) == files  # flat, nothing left behind
        stamps = []
        for p in files:
            with open(p) as f:
                arr = json.load(f)  # every file is one valid JSON array
            stamps += [(r["event_timestamp"], r["event_id"]) for r in arr]
            hour = os.path.basename(p)[7:20]
            assert all(r["event_timestamp"][:10] + "_" + r["event_timestamp"][11:13] == hour for r in arr)
        assert [t for t, _ in stamps] == sorted(t for t, _ in stamps)  # file order is event order
        assert len(stamps) == ev.count()
        assert len(files) == hours if rows_per_file is None else len(files) > hours


def test_export_splits_a_burst_within_one_second(spark, tmpdir_path):
    rows = spark.range(50_000).selectExpr(
        "lpad(cast(id * 7919 % 50000 as string), 6, '0') as event_id", "'s' as shipment_id", "10 as status_code",
        "cast(1 as long) as facility_id", "'2024-01-01T05:00:00Z' as event_timestamp", "cast(null as string) as courier_notes")
    export_hourly_json(rows, f"{tmpdir_path}/burst", rows_per_file=10_000)
    files = sorted(glob.glob(f"{tmpdir_path}/burst/*.json"))
    parts = [[r["event_id"] for r in json.load(open(p))] for p in files]
    assert len(files) > 3 and max(map(len, parts)) < 20_000
    ids = [i for part in parts for i in part]
    assert ids == sorted(ids) and len(set(ids)) == 50_000


def test_streams_lose_no_file_over_many_micro_batches(spark, tmpdir_path):
    from parcelspark.streaming.ingest import event_file_stream

    ev = fixtures.raw_tracking_events(spark, SF_SMALL).limit(60)
    ev.write.parquet(f"{tmpdir_path}/ev")
    ev = spark.read.parquet(f"{tmpdir_path}/ev")
    flat = f"{tmpdir_path}/flat"
    export_hourly_json(ev, flat)
    n = len(glob.glob(f"{flat}/events_*.json"))
    got = stream_ingest_events(spark, flat, f"{tmpdir_path}/s/data", f"{tmpdir_path}/s/ck", max_files_per_trigger=3)
    assert got == {"events_loaded": 60, "batches": -(-n // 3)}
    batch = tracking_json.read_event_files(spark, flat)
    assert spark.read.parquet(f"{tmpdir_path}/s/data").exceptAll(batch).count() == 0
    # a nested layout repeats file names: known by path
    for k in range(4):
        os.makedirs(f"{tmpdir_path}/nested/d{k}")
        _write(f"{tmpdir_path}/nested/d{k}/events_x.json", [dict(REC, event_id=f"n{k}")])
    with pytest.raises(ValueError):
        event_file_stream(spark, f"{tmpdir_path}/nested/d*")
    got = stream_ingest_events(spark, f"{tmpdir_path}/nested", f"{tmpdir_path}/n/data", f"{tmpdir_path}/n/ck",
                               max_files_per_trigger=1, nested=True)
    assert got == {"events_loaded": 4, "batches": 4}
    assert spark.read.parquet(f"{tmpdir_path}/n/data").select("source_file").distinct().count() == 4


def test_weather_csv_round_trip_and_missing_object(spark, tmpdir_path):
    wx = fixtures.raw_weather(spark, SF_SMALL)
    path = f"{tmpdir_path}/bucket/historical_weather_delays.csv"
    weather_csv.write_weather_csv(wx, path)
    back = weather_csv.read_weather_csv(spark, path)
    assert back.schema == wx.schema or dict(back.dtypes) == dict(wx.dtypes)
    assert back.exceptAll(wx).count() == 0 and wx.exceptAll(back).count() == 0
    text = open(glob.glob(f"{path}/part-*.csv")[0]).read()
    assert "True" in text or "False" in text
    with pytest.raises(weather_csv.SourceMissingError):
        weather_csv.read_weather_csv(spark, f"{tmpdir_path}/nobucket/x.csv")


def test_seed_csv(spark, tmpdir_path):
    p = f"{tmpdir_path}/status_codes_mapping.csv"
    with open(p, "w") as f:
        f.write("status_code,status_name,is_final_state,is_exception\n")
        for code, name, final, exc in STATUS_CODE_ROWS:
            f.write(f"{code},{name},{str(final).lower()},{str(exc).lower()}\n")
    rows = [tuple(r) for r in read_status_codes_csv(spark, p).collect()]
    assert rows == STATUS_CODE_ROWS


def test_incremental_scan_is_strict_and_pushed_down(spark, tmpdir_path):
    from datetime import datetime

    ship = fixtures.raw_shipments(spark, SF_SMALL)
    path = f"{tmpdir_path}/shipments"
    ship.write.parquet(path)
    mark = ship.agg(F.max("created_at")).first()[0]
    src = spark.read.parquet(path)
    assert oltp.project_shipments(src, since=mark).count() == 0
    at_mark = ship.where(F.col("created_at") == mark).count()
    assert oltp.project_shipments(src, since=datetime(2000, 1, 1)).count() == ship.count()
    plan = oltp.project_shipments(src, since=datetime(2024, 1, 25))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThan(created_at" in plan
    assert at_mark >= 1
    assert oltp.high_water_mark(spark, f"{tmpdir_path}/absent") is None
    tables.replace(ship, f"{tmpdir_path}/wh-shipments")
    assert oltp.high_water_mark(spark, f"{tmpdir_path}/wh-shipments") == mark


def test_vacuum_removes_only_superseded_generations(spark, feed):
    from datetime import datetime, timedelta, timezone

    root, d = feed
    ev_t, led_t = f"{root}/wh3/events", f"{root}/wh3/ledger"
    assert event_table.vacuum(spark, ev_t, led_t, grace_hours=0) == []
    event_table.ingest_new_files(spark, d, ev_t, led_t)
    event_table.ingest_new_files(spark, d, ev_t, led_t, full_refresh=True)
    os.makedirs(f"{ev_t}/_generation=2")  # a refresh in flight
    assert event_table.vacuum(spark, ev_t, led_t) == []  # readers of the old one have had no grace yet
    later = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=25)
    assert event_table.vacuum(spark, ev_t, led_t, now=later) == [0]
    assert event_table.read_events_table(spark, ev_t, led_t).count() == 3
    assert sorted(os.listdir(ev_t)) == ["_generation=1", "_generation=2"]


def test_exceptions_stream_emits_only_new_events(spark, tmpdir_path):
    from parcelspark.sources import seed as seed_mod
    from parcelspark.streaming.exceptions import run_exceptions_feed
    from tests import helpers as H
    from parcelspark.plans.graph import ModelGraph

    g = ModelGraph(H.raw(spark, ship=[H.shipment("s1"), H.shipment("s2")]))
    enriched, codes = g.get("int_shipments_enriched"), seed_mod.status_codes(spark)
    d = f"{tmpdir_path}/feed"
    os.makedirs(d)
    base = {"shipment_id": "s1", "facility_id": 1, "event_timestamp": "2024-01-01T00:00:00Z"}
    _write(f"{d}/events_2024-01-01_00.json", [dict(base, event_id="a", status_code=10),
                                              dict(base, event_id="b", status_code=80)])
    sink, ck = f"{tmpdir_path}/exc/data", f"{tmpdir_path}/exc/ck"
    first = run_exceptions_feed(spark, d, enriched, codes, sink, ck, glob="events_*.json")
    assert sorted(r["event_id"] for r in spark.read.parquet(sink).collect()) == ["b"]
    _write(f"{d}/events_2024-01-01_01.json", [dict(base, event_id="c", shipment_id="s2", status_code=70),
                                              dict(base, event_id="d", shipment_id="ghost", status_code=60)])
    run_exceptions_feed(spark, d, enriched, codes, sink, ck, glob="events_*.json")
    rows = {r["event_id"]: r for r in spark.read.parquet(sink).collect()}
    assert sorted(rows) == ["b", "c"]  # the orphan event is dropped by the inner join
    assert rows["c"]["exception_type"] == "Damaged" and first == {"rows_written": 1, "batches": 1}
