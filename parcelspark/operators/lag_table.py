"""A stored lag that is maintained batch by batch.

``apply`` adds a batch of events to the table of (event, previous time of its
key).  A carried table holds each key's last event:

* keys whose new events all come after it only need the carried time: their
  rows are added, nothing stored is read;
* keys that got an older event are repaired: the stored rows of their buckets
  are read, those keys recomputed, and the buckets replaced.

Rows are stored in ``BUCKETS`` buckets of the key's hash.  A batch writes one
folder; the pointer names the folders and which buckets of each a later repair
replaced, and is swapped once, so readers see whole batches.  Ties in time are
ordered by the tiebreak column, nulls last, as in the full window.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators.lag import lag_by_key
from parcelspark.sources.fs import path_exists, read_file, swap_file

BUCKETS = 64


class LagTable:
    """``lag(ts) OVER (PARTITION BY key ORDER BY ts, tiebreak)`` as ``out``, over all batches so far."""

    def __init__(self, spark: SparkSession, root: str, key: str, ts: str, tiebreak: str, out: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.key, self.ts, self.tiebreak, self.out = key, ts, tiebreak, out

    def _state(self) -> dict:
        path = f"{self.root}/_current"
        return json.loads(read_file(self.spark, path)) if path_exists(self.spark, path) else {"parts": [], "last": None}

    def _stored(self, buckets: list[int] | None = None) -> DataFrame | None:
        """Stored rows with their ``_bucket``; of some buckets only if given (a partition filter)."""
        out = None
        for part in self._state()["parts"]:
            rows = self.spark.read.parquet(f"{self.root}/{part['folder']}")
            if part["replaced"]:
                rows = rows.where(~F.col("_bucket").isin(part["replaced"]))
            if buckets is not None:
                rows = rows.where(F.col("_bucket").isin(buckets))
            out = rows if out is None else out.unionByName(rows)
        return out

    def read(self) -> DataFrame:
        return self._stored().drop("_bucket")

    def _order(self) -> list:
        """Ascending, nulls last, as a comparable struct."""
        return [x for c in (self.ts, self.tiebreak) for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))]

    def _lagged(self, rows: DataFrame) -> DataFrame:
        return lag_by_key(rows, self.key, [self.ts, self.tiebreak], self.ts, self.out)

    def apply(self, batch: DataFrame) -> dict:
        """Add a batch of new events, in any order; returns what was repaired."""
        spark, state, step = self.spark, self._state(), uuid.uuid4().hex
        order = F.struct(*self._order())
        staged = f"{self.root}/staged-{step}"
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        batch.withColumn("_bucket", bucket).write.parquet(staged)
        new = spark.read.parquet(staged)
        per_key = new.groupBy(self.key).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
        repaired: list[int] = []
        if state["last"] is None:
            rows = self._lagged(new)
            last = per_key.select(self.key, F.col("_hi").alias("_last"))
        else:
            old = spark.read.parquet(f"{self.root}/{state['last']}")
            met = per_key.join(old.withColumnRenamed(self.key, "_k"), F.col(self.key).eqNullSafe(F.col("_k")), "left")
            keys_path = f"{self.root}/keys-{step}"
            met.select(self.key, "_lo", "_last", (F.col("_last") > F.col("_lo")).alias("_late"), bucket.alias("_b")).write.parquet(keys_path)
            keys = spark.read.parquet(keys_path)
            late = keys.where("_late").select(F.col(self.key).alias("_k"))
            # At most ``buckets`` numbers.
            repaired = sorted(r[0] for r in keys.where("_late").select("_b").distinct().collect())
            is_late = F.col(self.key).eqNullSafe(F.col("_k"))
            # In order: the carried time stands before the first new event of each key.
            carried = keys.where("_last is not null and not coalesce(_late, false)").select(
                F.col(self.key).alias("_k"), "_lo", F.col("_last")[self.ts].alias("_carried"))
            ahead = self._lagged(new.join(late, is_late, "left_anti")).join(carried, is_late, "left")
            is_first = F.col(self.out).isNull() & (order == F.col("_lo"))
            rows = ahead.withColumn(self.out, F.when(is_first, F.col("_carried")).otherwise(F.col(self.out))).select(
                *new.columns, self.out)
            if repaired:
                stored = self._stored(repaired)
                again = stored.join(late, is_late, "left_semi").drop(self.out).unionByName(new.join(late, is_late, "left_semi"))
                rows = rows.unionByName(self._lagged(again)).unionByName(stored.join(late, is_late, "left_anti"))
            last = old.unionByName(per_key.select(self.key, F.col("_hi").alias("_last"))).groupBy(self.key).agg(F.max("_last").alias("_last"))
        folder, last_folder = f"data-{step}", f"last-{step}"
        rows.repartition("_bucket", F.pmod(F.xxhash64(self.tiebreak), F.lit(8))).write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        last.write.parquet(f"{self.root}/{last_folder}")
        parts = [p | {"replaced": sorted({*p["replaced"], *repaired})} for p in state["parts"]]
        swap_file(spark, f"{self.root}/_current", json.dumps(
            {"parts": [*parts, {"folder": folder, "replaced": []}], "last": last_folder}))  # <- commit
        return {"repaired_buckets": len(repaired)}
