"""Exceptions feed that waits for late shipments.

Each micro-batch's exceptions, with those still pending, are joined with the
shipments known by then; the ones without a shipment become the new pending
table.  ``flush`` does the same without new events, after shipments arrived.
An exception is emitted once, so over time the feed equals
``mart_exceptions_analysis`` (shipment ids are unique: the staging gate's
check).  The state is the exceptions whose shipment is missing, not all
shipments or events.

A step writes its feed rows and its pending rows to new folders, then swaps
one pointer that names all folders and the last micro-batch; a micro-batch run
again after a crash is known by its number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators import marts as M
from parcelspark.operators.intermediate import tracking_with_status
from parcelspark.operators.staging import stg_tracking_events
from parcelspark.sources.fs import delete_dir, path_exists, read_file, swap_file
from parcelspark.streaming.ingest import event_file_stream

Shipments = Callable[[], DataFrame]


def _state(spark: SparkSession, root: str) -> dict:
    path = f"{root}/_current"
    return json.loads(read_file(spark, path)) if path_exists(spark, path) else {"feed": [], "pending": None, "batch": -1}


def _settle(spark: SparkSession, root: str, fresh: DataFrame | None, shipments: DataFrame, batch: int | None) -> None:
    """One step: emit what has a shipment, keep the rest pending."""
    state = _state(spark, root)
    if batch is not None and batch <= state["batch"]:
        return  # committed by a run that died before its checkpoint
    waiting = spark.read.parquet(f"{root}/{state['pending']}") if state["pending"] else None
    if fresh is None and waiting is None:
        return
    parts = [x for x in (fresh, waiting) if x is not None]
    step = uuid.uuid4().hex
    todo_path, feed, pending = f"{root}/todo-{step}", f"feed-{step}", f"pending-{step}"
    (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).write.parquet(todo_path)
    todo = spark.read.parquet(todo_path)
    M.mart_exceptions_analysis(shipments, todo).write.parquet(f"{root}/{feed}")
    # An exception without a shipment id never finds one.
    todo.where("shipment_id is not null").join(shipments.select("shipment_id"), "shipment_id", "left_anti") \
        .select(todo.columns).write.parquet(f"{root}/{pending}")
    swap_file(spark, f"{root}/_current", json.dumps({
        "feed": [*state["feed"], feed], "pending": pending, "batch": state["batch"] if batch is None else batch}))  # <- commit
    delete_dir(spark, todo_path)
    if state["pending"]:
        delete_dir(spark, f"{root}/{state['pending']}")


def drain(spark: SparkSession, events_path: str, shipments: Shipments, status_codes: DataFrame, root: str,
          glob: str, max_files_per_trigger: int | None = None) -> None:
    """Take in the event files that are new; ``shipments`` is asked for the known ones at each micro-batch."""
    codes = M.exception_codes(status_codes)

    def commit(batch: DataFrame, batch_id: int) -> None:
        typed = tracking_with_status(stg_tracking_events(batch), status_codes)
        fresh = typed.where(F.col("status_code").isin(codes) & F.col("is_exception"))
        _settle(batch.sparkSession, root, fresh, shipments(), batch_id)

    query = (
        event_file_stream(spark, events_path, glob, max_files_per_trigger).writeStream.foreachBatch(commit)
        .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def flush(spark: SparkSession, shipments: Shipments, root: str) -> None:
    """Emit the pending exceptions whose shipment has come."""
    _settle(spark, root, None, shipments(), None)


def read_feed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(*[f"{root}/{f}" for f in _state(spark, root)["feed"]])


def read_pending(spark: SparkSession, root: str) -> DataFrame | None:
    pending = _state(spark, root)["pending"]
    return spark.read.parquet(f"{root}/{pending}") if pending else None
