"""Tables stored in buckets of a key, so that joins and windows on it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.session import scratch_dir


def store_bucketed(df: DataFrame, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets, sorted by ``key``, and read it back.

    The rows are dealt by the same hash first, so each bucket is one file.  All
    tables of one ``buckets`` join on ``key`` bucket by bucket.
    """
    spark, name = df.sparkSession, f"parcelspark_{uuid.uuid4().hex}"
    path = path or scratch_dir(spark, "bucketed")
    df.repartition(buckets, F.col(key)).write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)
