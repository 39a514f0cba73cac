"""The 18 staging assertions; each check returns its violating rows.

* unique        -> one row per duplicated key (partial-aggregated group-by)
* not_null      -> one row per (table, column) with its NULL count; all
                   columns of one table in a single aggregation pass
* accepted_values -> one row per unexpected value (NULL passes)
* relationships -> the child rows whose non-NULL key has no parent
                   (left anti join; the parent broadcasts only behind a
                   size check, else a shuffle join whose probe side AQE
                   can split when a key is hot)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.expressions import FACILITY_TYPES
from parcelspark.operators.joins import bounded_broadcast, fits_broadcast


class QualityGateError(RuntimeError):
    """Raised when an assertion finds violations before marts are written."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ------------------------------------------------------------------ unique
def duplicated_keys(df: DataFrame, table: str, col: str) -> DataFrame:
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        .select(
            F.lit(table).alias("table_name"),
            F.lit(col).alias("column_name"),
            F.col(col).cast("string").alias("key_value"),
            "occurrences",
        )
    )


def dq_unique(stg_facilities: DataFrame, stg_shipments: DataFrame, stg_tracking: DataFrame) -> DataFrame:
    return _union([
        duplicated_keys(stg_facilities, "stg_facilities", "facility_id"),
        duplicated_keys(stg_shipments, "stg_shipments", "shipment_id"),
        duplicated_keys(stg_tracking, "stg_tracking_events", "event_id"),
    ])


# ---------------------------------------------------------------- not_null
NOT_NULL_COLUMNS = {
    "stg_facilities": ["facility_id"],
    "stg_shipments": ["shipment_id", "origin_facility_id", "destination_facility_id"],
    "stg_tracking_events": ["event_id", "shipment_id", "status_code"],
    "stg_weather_delays": ["weather_date", "city", "weather_condition"],
}


def null_counts(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """One scan, one global aggregate, unpivoted to (table, column, failures)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot([], cols, "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", F.col("failures").cast("long").alias("failures")
    )


def dq_not_null(frames: dict[str, DataFrame]) -> DataFrame:
    return _union([null_counts(frames[t], t, cols) for t, cols in NOT_NULL_COLUMNS.items() if t in frames])


# --------------------------------------------------------- accepted_values
def dq_accepted_values(stg_facilities: DataFrame) -> DataFrame:
    c = F.col("facility_type")
    return (
        stg_facilities.where(c.isNotNull() & ~c.isin(FACILITY_TYPES))
        .groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# ----------------------------------------------------------- relationships
def orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, keep: list[str],
    broadcast_parent: bool = True,
) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias(child_key))
    if broadcast_parent:
        keys = bounded_broadcast(keys, source=parent)
    return (
        child.where(F.col(child_key).isNotNull())
        .select(*keep)
        .join(keys, child_key, "left_anti")
    )


def dq_rel_origin(stg_shipments: DataFrame, stg_facilities: DataFrame) -> DataFrame:
    return orphans(stg_shipments, "origin_facility_id", stg_facilities, "facility_id",
                   ["shipment_id", "origin_facility_id"])


def dq_rel_destination(stg_shipments: DataFrame, stg_facilities: DataFrame) -> DataFrame:
    return orphans(stg_shipments, "destination_facility_id", stg_facilities, "facility_id",
                   ["shipment_id", "destination_facility_id"])


def dq_rel_event_shipment(stg_tracking: DataFrame, stg_shipments: DataFrame) -> DataFrame:
    # Both sides are large: a shuffle anti join (AQE splits a hot probe key).
    return orphans(stg_tracking, "shipment_id", stg_shipments, "shipment_id",
                   ["event_id", "shipment_id"], broadcast_parent=False)


def dq_rel_event_status(stg_tracking: DataFrame, status_codes: DataFrame) -> DataFrame:
    return orphans(stg_tracking, "status_code", status_codes, "status_code", ["event_id", "status_code"])


# ----------------------------------------------------------------- summary
def _count_row(df: DataFrame, table: str, col: str, test: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
        F.lit(test).alias("test_name"), "failures",
    )


def _rows(agg: DataFrame, table: str, checks: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate of failure counts into summary rows;
    ``checks`` = [(agg column, column_name, test_name)].

    A single ``unpivot`` (one Expand over one aggregate) keeps the pass fused:
    a union of per-check selects would let column pruning split the
    aggregate back into one scan per check.
    """
    srcs = [c[0] for c in checks]
    long = agg.select(*[F.col(c).cast("long").alias(c) for c in srcs]).unpivot([], srcs, "_src", "failures")
    column, test = None, None
    for src, col, tst in checks:
        cond = F.col("_src") == src
        column = F.when(cond, F.lit(col)) if column is None else column.when(cond, F.lit(col))
        test = F.when(cond, F.lit(tst)) if test is None else test.when(cond, F.lit(tst))
    return long.select(
        F.lit(table).alias("table_name"), column.alias("column_name"), test.alias("test_name"), "failures"
    )


def _fused_shipments(stg_shipments: DataFrame, stg_facilities: DataFrame) -> DataFrame | None:
    """not_null x3 and both facility relationships in one pass over shipments
    (two broadcast lookups into the distinct facility ids); ``None`` when the
    id set is too large to broadcast."""
    ids = stg_facilities.select("facility_id").where(F.col("facility_id").isNotNull()).distinct()
    if not fits_broadcast(ids, source=stg_facilities):
        return None
    ids = F.broadcast(ids)
    o = ids.select(F.col("facility_id").alias("_o"))
    d = ids.select(F.col("facility_id").alias("_d"))
    s = stg_shipments.select("shipment_id", "origin_facility_id", "destination_facility_id")
    j = s.join(o, s["origin_facility_id"] == o["_o"], "left").join(d, s["destination_facility_id"] == d["_d"], "left")
    agg = j.agg(
        F.count_if(F.col("shipment_id").isNull()).alias("nn_id"),
        F.count_if(F.col("origin_facility_id").isNull()).alias("nn_o"),
        F.count_if(F.col("destination_facility_id").isNull()).alias("nn_d"),
        F.count_if(F.col("origin_facility_id").isNotNull() & F.col("_o").isNull()).alias("rel_o"),
        F.count_if(F.col("destination_facility_id").isNotNull() & F.col("_d").isNull()).alias("rel_d"),
    )
    return _rows(agg, "stg_shipments", [
        ("nn_id", "shipment_id", "not_null"),
        ("nn_o", "origin_facility_id", "not_null"),
        ("nn_d", "destination_facility_id", "not_null"),
        ("rel_o", "origin_facility_id", "relationships"),
        ("rel_d", "destination_facility_id", "relationships"),
    ])


def _fused_events(stg_tracking: DataFrame, status_codes: DataFrame) -> DataFrame:
    """not_null x3 and the status relationship in one pass over events."""
    codes = bounded_broadcast(status_codes.select(F.col("status_code").alias("_c")).distinct(), source=status_codes)
    e = stg_tracking.select("event_id", "shipment_id", "status_code")
    agg = e.join(codes, F.col("status_code") == F.col("_c"), "left").agg(
        F.count_if(F.col("event_id").isNull()).alias("nn_e"),
        F.count_if(F.col("shipment_id").isNull()).alias("nn_s"),
        F.count_if(F.col("status_code").isNull()).alias("nn_c"),
        F.count_if(F.col("status_code").isNotNull() & F.col("_c").isNull()).alias("rel_c"),
    )
    return _rows(agg, "stg_tracking_events", [
        ("nn_e", "event_id", "not_null"),
        ("nn_s", "shipment_id", "not_null"),
        ("nn_c", "status_code", "not_null"),
        ("rel_c", "status_code", "relationships"),
    ])


def _fused_facilities(stg_facilities: DataFrame) -> DataFrame:
    t = F.col("facility_type")
    agg = stg_facilities.agg(
        F.count_if(F.col("facility_id").isNull()).alias("nn"),
        # accepted_values returns one row per unexpected value
        F.count_distinct(F.when(t.isNotNull() & ~t.isin(FACILITY_TYPES), t)).alias("acc"),
    )
    return _rows(agg, "stg_facilities", [("nn", "facility_id", "not_null"),
                                         ("acc", "facility_type", "accepted_values")])


def dq_summary(
    stg_facilities: DataFrame,
    stg_shipments: DataFrame,
    stg_tracking: DataFrame,
    stg_weather: DataFrame | None,
    status_codes: DataFrame,
) -> DataFrame:
    """All assertions as (table_name, column_name, test_name, failures):
    18 rows, or 15 when the weather model is not part of the run.

    Checks on the same table share one aggregation pass (not_null, accepted
    values, relationships to broadcastable parents); only the uniqueness
    checks and the event -> shipment relationship need their own shuffles.
    """
    shipments = _fused_shipments(stg_shipments, stg_facilities)
    if shipments is None:  # facility ids too many to broadcast: shuffle anti joins
        shipments = _union([
            null_counts(stg_shipments, "stg_shipments", NOT_NULL_COLUMNS["stg_shipments"]).select(
                "table_name", "column_name", F.lit("not_null").alias("test_name"), "failures"),
            _count_row(dq_rel_origin(stg_shipments, stg_facilities),
                       "stg_shipments", "origin_facility_id", "relationships"),
            _count_row(dq_rel_destination(stg_shipments, stg_facilities),
                       "stg_shipments", "destination_facility_id", "relationships"),
        ])
    rows = [
        _count_row(duplicated_keys(stg_facilities, "stg_facilities", "facility_id"),
                   "stg_facilities", "facility_id", "unique"),
        _count_row(duplicated_keys(stg_shipments, "stg_shipments", "shipment_id"),
                   "stg_shipments", "shipment_id", "unique"),
        _count_row(duplicated_keys(stg_tracking, "stg_tracking_events", "event_id"),
                   "stg_tracking_events", "event_id", "unique"),
        _fused_facilities(stg_facilities),
        shipments,
        _fused_events(stg_tracking, status_codes),
        _count_row(dq_rel_event_shipment(stg_tracking, stg_shipments),
                   "stg_tracking_events", "shipment_id", "relationships"),
    ]
    if stg_weather is not None:
        rows.append(null_counts(stg_weather, "stg_weather_delays", NOT_NULL_COLUMNS["stg_weather_delays"]).select(
            "table_name", "column_name", F.lit("not_null").alias("test_name"), "failures"))
    return _union(rows)


def _dup_keys_touching(all_rows: DataFrame, new_rows: DataFrame, key: str) -> DataFrame:
    """Keys duplicated in ``all_rows`` among the keys of ``new_rows``.

    When the previously validated rows had no duplicate, every duplicate key
    involves a new row, so this equals the full uniqueness check while only
    the new keys are shuffled or broadcast (the full table contributes one
    narrow key column probed against them).
    """
    new_keys = new_rows.select(key).where(F.col(key).isNotNull()).distinct()
    return (
        all_rows.select(key)
        .join(bounded_broadcast(new_keys), key, "left_semi")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def dq_summary_incremental(
    stg_facilities: DataFrame,
    stg_shipments: DataFrame,
    new_shipments: DataFrame,
    stg_tracking: DataFrame,
    new_tracking: DataFrame,
    status_codes: DataFrame,
) -> DataFrame:
    """The 15 hourly assertions, exact *given the last validated state
    passed them*: rows appended since then are ``new_*``; facilities are
    replaced every run, so every check that involves them runs in full.

    * facilities: all checks in full (small dimension);
    * shipments: not_null + both facility relationships in full (one narrow
      pass, the parent changed), uniqueness on keys of the new rows;
    * events: uniqueness on keys of the new rows; not_null, status and
      shipment relationships on the new rows only (their parents only grow).
    """
    shipments = _fused_shipments(stg_shipments, stg_facilities)
    if shipments is None:
        shipments = _union([
            null_counts(stg_shipments, "stg_shipments", NOT_NULL_COLUMNS["stg_shipments"]).select(
                "table_name", "column_name", F.lit("not_null").alias("test_name"), "failures"),
            _count_row(dq_rel_origin(stg_shipments, stg_facilities),
                       "stg_shipments", "origin_facility_id", "relationships"),
            _count_row(dq_rel_destination(stg_shipments, stg_facilities),
                       "stg_shipments", "destination_facility_id", "relationships"),
        ])
    return _union([
        _count_row(duplicated_keys(stg_facilities, "stg_facilities", "facility_id"),
                   "stg_facilities", "facility_id", "unique"),
        _count_row(_dup_keys_touching(stg_shipments, new_shipments, "shipment_id"),
                   "stg_shipments", "shipment_id", "unique"),
        _count_row(_dup_keys_touching(stg_tracking, new_tracking, "event_id"),
                   "stg_tracking_events", "event_id", "unique"),
        _fused_facilities(stg_facilities),
        shipments,
        _fused_events(new_tracking, status_codes),
        _count_row(dq_rel_event_shipment(new_tracking, stg_shipments),
                   "stg_tracking_events", "shipment_id", "relationships"),
    ])


def enforce(summary: DataFrame) -> list[dict]:
    """Collect the (18-row, bounded) summary and raise on any violation."""
    return raise_on_failures([r.asDict() for r in summary.collect()])


def raise_on_failures(rows: list[dict]) -> list[dict]:
    failed = [r for r in rows if r["failures"]]
    if failed:
        detail = ", ".join(
            f"{r['test_name']}({r['table_name']}.{r['column_name']})={r['failures']}" for r in failed
        )
        raise QualityGateError(f"data-quality gate failed: {detail}")
    return rows
