from pyspark.sql import functions as F

from parcelspark.llm import common


def test_arrays_count_towards_the_broadcast_bound(spark):
    few = spark.range(5)
    for big in (
        few.select("id", F.sequence(F.lit(1), F.lit(1_000_000)).alias("dropped")),
        few.select("id", F.array_repeat(F.lit("w" * 20), 400_000).alias("terms")),
        few.select(F.array_repeat(F.struct(F.lit(1).alias("a"), F.lit("text").alias("b")), 500_000).alias("items")),
    ):
        assert common.broadcast_if_small(big) is big
    small = few.select("id", F.array(F.lit("a"), F.lit(None)).alias("x"), F.create_map(F.lit("k"), F.lit(1)).alias("m"),
                       F.lit(None).cast("array<struct<a:int>>").alias("n"), F.lit(None).cast("string").alias("s"))
    assert common.broadcast_if_small(small) is not small
    assert common.broadcast_if_small(small.limit(0)).count() == 0
