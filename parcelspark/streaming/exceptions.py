"""Hourly exceptions feed as a stream-static join.

New event files stream in; each micro-batch is typed like staging, joined to
the (static, broadcast) status seed, filtered to exception statuses and
joined to the static enriched shipments.  No lag is needed, so the stream
keeps no state; the output equals ``mart_exceptions_analysis`` restricted
to the newly arrived events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelspark.operators import marts as M
from parcelspark.operators.intermediate import tracking_with_status
from parcelspark.operators.staging import stg_tracking_events
from parcelspark.streaming.ingest import event_file_stream, run_available_now


def exceptions_stream(events_stream: DataFrame, shipments_enriched: DataFrame, status_codes: DataFrame) -> DataFrame:
    typed = tracking_with_status(stg_tracking_events(events_stream), status_codes)
    return M.mart_exceptions_analysis(shipments_enriched, typed, status_codes)


def run_exceptions_feed(
    spark: SparkSession,
    events_path: str,
    shipments_enriched: DataFrame,
    status_codes: DataFrame,
    sink_dir: str,
    checkpoint_dir: str,
    glob: str,
    max_files_per_trigger: int | None = None,
) -> dict:
    """An exception whose shipment is not known yet is not emitted, nor later:
    the daily job rebuilds the mart from all events and repairs the feed."""
    stream = exceptions_stream(
        event_file_stream(spark, events_path, glob, max_files_per_trigger), shipments_enriched, status_codes)
    return run_available_now(stream, sink_dir, checkpoint_dir)
