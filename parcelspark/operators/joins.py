"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.session import CONF_BROADCAST_MAX_ROWS, conf_int

DEFAULT_BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 256 << 20
_FIXED_WIDTH = 16  # generous for a number, date or flag

# Per source frame: (rows, bytes).  A frame's plan (and file listing) is
# fixed, so its size holds for its lifetime; a new load is a new frame.
_SIZES: "weakref.WeakKeyDictionary[DataFrame, tuple[int, int]]" = weakref.WeakKeyDictionary()


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) by one aggregate: tasks send two numbers each, no rows move."""
    if df not in _SIZES:
        width = F.lit(0)
        for f in df.schema.fields:
            if f.dataType.typeName() in ("string", "binary"):
                width = width + F.coalesce(F.octet_length(df[f.name]), F.lit(0))
            elif f.dataType.typeName() in ("array", "map", "struct"):
                width = width + F.coalesce(F.octet_length(F.to_json(df[f.name])), F.lit(0))
            else:
                width = width + F.lit(_FIXED_WIDTH)
        rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
        _SIZES[df] = (rows, size or 0)
    return _SIZES[df]


def fits_broadcast(df: DataFrame, max_rows: int | None = None, source: DataFrame | None = None) -> bool:
    """True iff ``df`` has at most ``max_rows`` rows and ``BROADCAST_MAX_BYTES`` bytes.

    ``source``: a frame ``df`` is a projection / filter / distinct of (so it is
    no larger); the check then runs once on ``source`` and is reused by every
    such dimension derived from it.
    """
    limit = max_rows or conf_int(df.sparkSession, CONF_BROADCAST_MAX_ROWS, DEFAULT_BROADCAST_MAX_ROWS)
    rows, size = measured_size(df if source is None else source)
    return rows <= limit and size <= BROADCAST_MAX_BYTES


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its size is proven small, else ``df``.

    Beyond the bound the join stays a shuffle join; AQE may still convert it
    at runtime from measured sizes, and its skew-join rule splits hot keys.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, source) else df
