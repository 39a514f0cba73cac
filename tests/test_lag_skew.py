"""The skew-aware lag equals the plain window, also when keys are hot."""

from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelspark.operators.lag import hot_keys, lag_by_key
from parcelspark.session import CONF_SKEW_ROWS_PER_TASK, CONF_SKEW_SAMPLE_FRACTION
from parcelspark.sources import fixtures
from tests.conftest import SF_SMALL


def _plain(df):
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last())
    return df.withColumn("prev", F.lag("ts").over(w))


def _force_hot(spark, rows_per_task, fraction):
    old = (spark.conf.get(CONF_SKEW_ROWS_PER_TASK, None), spark.conf.get(CONF_SKEW_SAMPLE_FRACTION, None))
    spark.conf.set(CONF_SKEW_ROWS_PER_TASK, str(rows_per_task))
    spark.conf.set(CONF_SKEW_SAMPLE_FRACTION, str(fraction))
    return old


def _restore(spark, old):
    for key, val in zip((CONF_SKEW_ROWS_PER_TASK, CONF_SKEW_SAMPLE_FRACTION), old):
        if val is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, val)


def _rows(df):
    return sorted((r["id"], r["prev"]) for r in df.select("id", "prev").collect())


def test_hot_key_is_split_and_stitched(spark):
    base = datetime(2024, 1, 1)
    rows = [("hot", f"h{i:05d}", base + timedelta(seconds=37 * i)) for i in range(3000)]
    rows += [("hot", "tie-b", base + timedelta(seconds=74)), ("hot", "tie-a", base + timedelta(seconds=74))]
    rows += [("hot", "null-ts", None)]
    rows += [(f"k{j}", f"c{j}-{i}", base + timedelta(minutes=i)) for j in range(50) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz")
    old = _force_hot(spark, 200, 1.0)
    try:
        hot = hot_keys(df, "k", 200, 1.0).collect()
        assert [(r["k"], r["_rows"]) for r in hot] == [("hot", 3003)]
        got = lag_by_key(df, "k", ["ts", "id"], "ts", "prev")
        assert _rows(got) == _rows(_plain(df))
    finally:
        _restore(spark, old)


def test_every_key_hot_matches_plain_window_on_fixture(spark):
    ev = fixtures.raw_tracking_events(spark, SF_SMALL).select(
        F.col("shipment_id").alias("k"), F.col("event_id").alias("id"),
        F.col("event_timestamp").cast("timestamp_ntz").alias("ts"),
    )
    old = _force_hot(spark, 8, 1.0)
    try:
        got = lag_by_key(ev, "k", ["ts", "id"], "ts", "prev")
        assert _rows(got) == _rows(_plain(ev))
    finally:
        _restore(spark, old)


def test_no_hot_key_uses_plain_window(spark):
    df = spark.createDataFrame([("a", "1", datetime(2024, 1, 1))], "k string, id string, ts timestamp_ntz")
    plan = lag_by_key(df, "k", ["ts", "id"], "ts", "prev")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_hot_path_lagging_a_non_order_column(spark):
    """The generic (max_by) tail path: lag a payload column, not the timestamp."""
    base = datetime(2024, 1, 1)
    rows = [("hot", f"h{i:04d}", base + timedelta(seconds=11 * i), i) for i in range(800)]
    rows += [("cold", "c1", base, -1)]
    df = spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz, v int")
    old = _force_hot(spark, 100, 1.0)
    try:
        got = lag_by_key(df, "k", ["ts", "id"], "v", "prev")
    finally:
        _restore(spark, old)
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last())
    plain = df.withColumn("prev", F.lag("v").over(w))
    assert _rows(got) == _rows(plain)


def test_randomized_skewed_inputs_match_plain_window(spark):
    import random

    rnd = random.Random(11)
    base = datetime(2024, 1, 1)
    for trial, budget in enumerate([17, 60]):
        rows = []
        for i in range(1500):
            k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 40)}"
            ts = None if rnd.random() < 0.03 else base + timedelta(seconds=rnd.randint(0, 500) * 7)
            rows.append((k, f"e{trial}-{rnd.randint(0, 10**6):07d}-{i}", ts, i))
        df = spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz, v int")
        old = _force_hot(spark, budget, 1.0)
        try:
            got_ts = lag_by_key(df, "k", ["ts", "id"], "ts", "prev")
            got_v = lag_by_key(df, "k", ["ts", "id"], "v", "prev")
        finally:
            _restore(spark, old)
        w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_last(), F.col("id").asc_nulls_last())
        assert _rows(got_ts) == _rows(df.withColumn("prev", F.lag("ts").over(w))), trial
        assert _rows(got_v) == _rows(df.withColumn("prev", F.lag("v").over(w))), trial


def _largest_chunk(spark, monkeypatch, df, budget):
    """Rows of the largest (key, chunk) that the split path's windows see."""
    from parcelspark.operators import lag

    written = {}
    keep = lag._written
    monkeypatch.setattr(lag, "_written", lambda d, purpose: written.setdefault(purpose, keep(d, purpose)))
    got = lag_by_key(df, "k", ["ts", "id"], "ts", "prev", rows_per_task=budget, sample_fraction=1.0)
    assert _rows(got) == _rows(_plain(df))
    return written["lag-chunks"].groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]


def test_burst_at_one_instant_is_split(spark, monkeypatch):
    base = datetime(2024, 1, 1)
    rows = [("hot", f"b{i:06d}", base + timedelta(days=1)) for i in range(9_999)] + [("hot", "first", base), ("k", "c", base)]
    df = spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz")
    assert _largest_chunk(spark, monkeypatch, df, 1000) <= 2000


def test_null_keys_are_split(spark, monkeypatch):
    base = datetime(2024, 1, 1)
    rows = [(None, f"n{i:05d}", base + timedelta(seconds=i)) for i in range(5_000)] + [("k", "c", base)]
    df = spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz")
    assert _largest_chunk(spark, monkeypatch, df, 1000) <= 2000


def test_no_single_partition_exchange_over_the_events(spark):
    from parcelspark.plans import queries as Q

    for key in ("int_tracking_with_lag", "int_tracking_with_lag_hot"):
        plan = Q.sql_queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "LocalLimit" not in plan and "GlobalLimit" not in plan, key


def test_files_and_tasks_follow_the_session_not_the_chunks(spark, monkeypatch):
    """Chunks of a low budget share partitions: 8 files here, where each of 120 chunks had its own."""
    from parcelspark.operators import lag

    base = datetime(2024, 1, 1)
    rows = [(None, f"n{i:05d}", base + timedelta(seconds=i % 700)) for i in range(6_000)] + [("k", "c", base)]
    df = spark.createDataFrame(rows, "k string, id string, ts timestamp_ntz")
    written = {}
    keep = lag._written
    monkeypatch.setattr(lag, "_written", lambda d, purpose: written.setdefault(purpose, keep(d, purpose)))
    got = lag_by_key(df, "k", ["ts", "id"], "ts", "prev", rows_per_task=100, sample_fraction=1.0)
    assert _rows(got) == _rows(_plain(df))
    sizes = [r["count"] for r in written["lag-chunks"].groupBy("_chunk").count().collect()]
    assert len(written["lag-chunks"].inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) >= 120 and max(sizes) <= 50
