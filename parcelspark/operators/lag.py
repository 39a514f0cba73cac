"""Skew-aware ``lag`` over (key ORDER BY ts, tiebreak).

A plain ``lag() OVER (PARTITION BY key ...)`` puts every row of a key into one
task.  If one key holds a large share of all rows that task holds it all.
Here hot keys are found from a sample and handled apart:

1. sample -> keys (NULL is one of them) whose sampled frequency implies more
   than ``parcelspark.skew.rowsPerTask`` rows.  The table has at most
   ``2 * rows / rowsPerTask`` entries and, if it has any, is written once to
   the shared folder, so every later branch sees the same keys.
2. The hot keys' rows are range-partitioned on (key, ts, tiebreak), sorted and
   written once; every so many rows of a partition are one ``_chunk``.  The
   bounds are quantiles of the whole order, so a burst at one instant is split
   as well, by the tiebreak.  The number of partitions, each a task and a file,
   follows the session's shuffle partitions and the rows, not the chunks.
3. ``lag`` over (key, chunk) spreads a hot key over many tasks.
4. The first row of each chunk takes the last value of the previous chunk of
   its key (a small per-chunk table).

All other rows take the plain window.  With no hot key the plan is the plain
window alone; the probe reads a sample of the key column.

Defaults: 2M rows per window task, a 1e-4 Bernoulli sample (a hot key shows
~200 expected hits against a threshold of 100; on 1e12 rows the probe
shuffles ~1e8 sampled keys, partial-aggregated).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.operators.joins import bounded_broadcast
from parcelspark.session import (
    CONF_SKEW_ROWS_PER_TASK,
    CONF_SKEW_SAMPLE_FRACTION,
    conf_float,
    conf_int,
    scratch_dir,
)

DEFAULT_ROWS_PER_TASK = 2_000_000
DEFAULT_SAMPLE_FRACTION = 0.0001
MAX_CHUNKS = 20_000
_ROW_BITS = 33  # of monotonically_increasing_id: the row's number within its partition
_SAMPLE_SEED = 20240101


def _order(cols: list[str]) -> list[Column]:
    # Ascending, NULLs last (the reference engine's default ordering).
    return [F.col(c).asc_nulls_last() for c in cols]


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partitions(spark: SparkSession, chunks: int, rows: int) -> int:
    """Partitions of ``rows`` hot rows that are cut into ``chunks`` chunks."""
    wanted = max(conf_int(spark, "spark.sql.shuffle.partitions", 200), -(-rows // DEFAULT_ROWS_PER_TASK))
    return min(chunks, wanted)


def hot_keys(df: DataFrame, key: str, rows_per_task: int, fraction: float) -> DataFrame:
    """(key, _rows): sampled heavy hitters of ``key``, NULL included, and their estimated rows."""
    min_hits = max(1, int(fraction * rows_per_task / 2))
    keys = df.select(key) if fraction >= 1.0 else df.select(key).sample(fraction, seed=_SAMPLE_SEED)
    return (
        keys.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_hits"))
        .where(F.col("_hits") >= min_hits)
        .select(key, F.ceil(F.col("_hits") / F.lit(fraction)).alias("_rows"))
    )


def lag_by_key(
    df: DataFrame,
    key: str,
    order_cols: list[str],
    value_col: str,
    out_col: str,
    rows_per_task: int | None = None,
    sample_fraction: float | None = None,
) -> DataFrame:
    """``df`` plus ``out_col = lag(value_col) OVER (PARTITION BY key ORDER BY order_cols)``.

    The last of ``order_cols`` should break ties, else their order is open, as
    in the plain window.
    """
    spark = df.sparkSession
    budget = rows_per_task or conf_int(spark, CONF_SKEW_ROWS_PER_TASK, DEFAULT_ROWS_PER_TASK)
    fraction = min(1.0, sample_fraction or conf_float(spark, CONF_SKEW_SAMPLE_FRACTION, DEFAULT_SAMPLE_FRACTION))
    plain = F.lag(value_col).over(Window.partitionBy(key).orderBy(*_order(order_cols)))
    found = hot_keys(df, key, budget, fraction)
    rows = found.agg(F.sum("_rows")).first()[0]
    if not rows:
        return df.withColumn(out_col, plain)

    hot = _written(found, "lag-hot-keys")
    hot_b = bounded_broadcast(hot.select(F.col(key).alias("_hot_key")))
    is_hot = df[key].eqNullSafe(F.col("_hot_key"))
    cold = df.join(hot_b, is_hot, "left_anti").withColumn(out_col, plain)
    chunks = int(min(MAX_CHUNKS, max(2, -(-2 * rows // budget))))
    order = [F.col(key), *_order(order_cols)]
    ranged = df.join(hot_b, is_hot, "left_semi").repartitionByRange(_partitions(spark, chunks, rows), *order)
    # The id is the partition's number above _ROW_BITS bits of the row's number within it.
    row_mask = (1 << _ROW_BITS) - 1
    chunk_rows = max(budget // 2, -(-rows // MAX_CHUNKS), 1)
    numbered = ranged.sortWithinPartitions(*order).withColumn("_chunk", F.monotonically_increasing_id()).withColumn(
        "_chunk", F.expr(f"_chunk - (_chunk & {row_mask}L) + (_chunk & {row_mask}L) div {chunk_rows}L"))
    chunked = _written(numbered, "lag-chunks")

    w = Window.partitionBy(key, "_chunk").orderBy(*_order(order_cols))
    windowed = chunked.withColumn("_lag", F.lag(value_col).over(w)).withColumn(
        "_first", F.lag(F.lit(True)).over(w).isNull()
    )
    # Last value of each chunk, then the previous chunk's last.  NULLs-last
    # order == order by (isNull, value) per column.
    fields = []
    for i, c in enumerate(order_cols):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_v{i}")]
    last = chunked.groupBy(key, "_chunk").agg(F.max_by(F.struct(F.col(value_col).alias("v")), F.struct(*fields)).alias("_last"))
    prev = last.select(
        F.col(key).alias("_prev_key"), F.col("_chunk").alias("_prev_chunk"),
        F.lag("_last").over(Window.partitionBy(key).orderBy("_chunk"))["v"].alias("_prev_last"),
    )
    met = windowed[key].eqNullSafe(F.col("_prev_key")) & (windowed["_chunk"] == F.col("_prev_chunk"))
    stitched = windowed.join(prev, met, "left").withColumn(
        out_col, F.when(F.col("_first"), F.col("_prev_last")).otherwise(F.col("_lag"))
    )
    return cold.unionByName(stitched.select(*cold.columns))
