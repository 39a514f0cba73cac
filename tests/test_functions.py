"""Property checks of the column functions against plain-Python definitions."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from parcelspark.functions import expressions as X
from parcelspark.functions import timeutil

EPOCH = datetime(1970, 1, 1)


def _minute_floor(ts: datetime) -> int:
    return int((ts - EPOCH) // timedelta(minutes=1))


def test_minute_boundaries_match_definition(spark):
    rnd = random.Random(7)
    base = datetime(1969, 12, 31, 23, 0)
    pairs = []
    for _ in range(2000):
        a = base + timedelta(seconds=rnd.randint(0, 4_000_000), microseconds=rnd.randint(0, 999_999))
        b = a + timedelta(seconds=rnd.randint(-200_000, 200_000), microseconds=rnd.randint(0, 999_999))
        pairs.append((a, b))
    pairs += [(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1)),
              (datetime(2024, 3, 31, 1, 59, 59), datetime(2024, 3, 31, 3, 0, 0))]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", timeutil.minute_boundaries_between(F.col("a"), F.col("b")).alias("m")).collect()
    for r in got:
        assert r["m"] == _minute_floor(r["b"]) - _minute_floor(r["a"]), (r["a"], r["b"])


def test_text_forms_round_trip(spark):
    ts = datetime(2024, 4, 18, 14, 30, 5)
    row = spark.createDataFrame([(ts,)], "t timestamp_ntz").select(
        timeutil.iso_utc_text(F.col("t")).alias("iso"),
        timeutil.hour_bucket(F.col("t")).alias("bucket"),
        timeutil.hour_bucket_from_text(timeutil.iso_utc_text(F.col("t"))).alias("bucket2"),
        timeutil.event_file_name(timeutil.hour_bucket(F.col("t"))).alias("file"),
        timeutil.iso_utc_text(F.col("t")).cast("timestamp_ntz").alias("back"),
    ).first()
    assert row["iso"] == "2024-04-18T14:30:05Z"
    assert row["bucket"] == row["bucket2"] == "2024-04-18_14"
    assert row["file"] == "events_2024-04-18_14.json"
    assert row["back"] == ts


def test_weight_brackets_follow_thresholds(spark):
    rnd = random.Random(3)
    ws = [Decimal(rnd.randint(0, 3000)) / 100 for _ in range(500)] + [Decimal("5.00"), Decimal("15.00"), None]
    df = spark.createDataFrame([(w,) for w in ws], "w decimal(5,2)")
    for r in df.select("w", X.weight_bracket(F.col("w")).alias("b")).collect():
        w = r["w"]
        exp = ("Heavy (>15kg)" if w is None or w >= 15 else "Medium (5-15kg)" if w >= 5 else "Light (<5kg)")
        assert r["b"] == exp
