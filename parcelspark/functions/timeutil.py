"""Time expressions with the reference's unit semantics, all zone-free.

Every function takes and returns ``Column`` objects built from built-in
Spark functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats (must equal the producer's text forms).
ISO_UTC_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"   # 2024-04-18T14:30:00Z
HOUR_BUCKET_TEXT = "yyyy-MM-dd_HH"          # 2024-04-18_14
EVENT_FILE_PREFIX = "events_"
EVENT_FILE_SUFFIX = ".json"


def minute_index(ts: Column) -> Column:
    """Whole minutes since 1970-01-01 00:00 of a ``timestamp_ntz`` wall clock.

    Built from calendar fields, so no session time zone is involved.
    """
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * F.lit(1440) + F.hour(ts).cast("long") * F.lit(60) + F.minute(ts).cast("long")


def minute_boundaries_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    This is the ``date_diff('minute', a, b)`` rule: 00:00:59 -> 00:01:01 is 1,
    unlike ``timestampdiff`` which counts full elapsed minutes (0 there).
    NULL if either side is NULL.
    """
    return minute_index(end) - minute_index(start)


def minutes_to_hours(minutes: Column) -> Column:
    """Integer minutes to DOUBLE hours (``/ 60.0`` as a double)."""
    return minutes.cast("double") / F.lit(60.0)


def mean_hours(sum_minutes: Column, count_minutes: Column) -> Column:
    """Mean of ``minutes / 60`` computed once from an exact integer sum.

    Summing already-divided doubles depends on summation order; summing the
    integer minutes and dividing once is order-independent and reproducible.
    """
    return F.try_divide(sum_minutes.cast("double"), count_minutes.cast("double")) / F.lit(60.0)


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a naive ``datetime`` built from its
    text, so neither the Python process zone nor the session zone applies."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def iso_utc_text(ts: Column) -> Column:
    """``timestamp_ntz`` -> ``2024-04-18T14:30:00Z`` text."""
    return F.date_format(ts, ISO_UTC_TEXT)


def hour_bucket_from_text(ts_text: Column) -> Column:
    """``2024-04-18T14:30:00Z`` -> ``2024-04-18_14`` (pure text slicing)."""
    return F.concat(F.substring(ts_text, 1, 10), F.lit("_"), F.substring(ts_text, 12, 2))


def hour_bucket(ts: Column) -> Column:
    """``timestamp_ntz`` -> ``2024-04-18_14``."""
    return F.date_format(ts, HOUR_BUCKET_TEXT)


def event_file_name(bucket: Column) -> Column:
    """Hour bucket -> ``events_2024-04-18_14.json``."""
    return F.concat(F.lit(EVENT_FILE_PREFIX), bucket, F.lit(EVENT_FILE_SUFFIX))
