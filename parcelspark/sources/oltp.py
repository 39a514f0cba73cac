"""Relational (OLTP) source: facilities and shipments, full or incremental.

The production path reads over JDBC in parallel (partitioned on
``created_at``); the same projection/predicate code runs on any DataFrame
with the raw schema (parquet in tests), and Catalyst pushes the predicate
into either scan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import schemas
from parcelspark.functions.expressions import HUB_FACILITY_TYPES
from parcelspark.functions.timeutil import ntz_literal

FACILITY_COLUMNS = [f.name for f in schemas.FACILITIES.fields]
SHIPMENT_COLUMNS = [f.name for f in schemas.SHIPMENTS.fields]


def _conform(df: DataFrame, schema) -> DataFrame:
    """Name-based projection to the declared types (never positional)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def project_facilities(raw: DataFrame) -> DataFrame:
    return _conform(raw, schemas.FACILITIES)


def project_shipments(raw: DataFrame, since: datetime | None = None) -> DataFrame:
    """All shipments, or only those created strictly after ``since``.

    Strict ``>``: a row with exactly the mark's timestamp that arrives late is
    not picked up until the next full load (same as the reference).
    """
    df = _conform(raw, schemas.SHIPMENTS)
    if since is not None:
        df = df.where(F.col("created_at") > ntz_literal(since))
    return df


def high_water_mark_frame(shipments: DataFrame) -> DataFrame:
    """``max(created_at)`` as a one-row frame (NULL when empty)."""
    return shipments.agg(F.max("created_at").alias("high_water_mark"))


def high_water_mark(spark: SparkSession, table_path: str | None) -> datetime | None:
    """Mark of an existing warehouse table; ``None`` if absent or empty."""
    from parcelspark.sinks import tables

    if not table_path or not tables.exists(spark, table_path):
        return None
    row = high_water_mark_frame(tables.read(spark, table_path)).first()
    return row["high_water_mark"] if row else None


def hub_facilities(facilities: DataFrame) -> DataFrame:
    return facilities.where(F.col("facility_type").isin(HUB_FACILITY_TYPES)).select(
        "facility_id", "facility_name", "facility_type"
    )


def shipments_by_creation(shipments: DataFrame) -> DataFrame:
    """Shipments in creation order (a range-partitioned global sort)."""
    return shipments.select(
        "shipment_id", "origin_facility_id", "destination_facility_id", "created_at"
    ).orderBy("created_at", "shipment_id")


# ---------------------------------------------------------------- JDBC path
def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetchsize: int = 10_000) -> dict[str, str]:
    # A plain TIMESTAMP keeps its wall clock whatever zone the JVM is in.
    opts = {"url": url, "fetchsize": str(fetchsize), "preferTimestampNTZ": "true"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def facilities_query() -> str:
    return "(SELECT " + ", ".join(FACILITY_COLUMNS) + " FROM facilities) AS f"


def shipments_query(since: datetime | None = None) -> str:
    where = f" WHERE created_at > TIMESTAMP '{since:%Y-%m-%d %H:%M:%S.%f}'" if since else ""
    return "(SELECT " + ", ".join(SHIPMENT_COLUMNS) + " FROM shipments" + where + ") AS s"


def read_facilities_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return project_facilities(
        spark.read.format("jdbc").options(**options).option("dbtable", facilities_query()).load()
    )


def shipment_bounds_query(since: datetime | None = None) -> str:
    where = f" WHERE created_at > TIMESTAMP '{since:%Y-%m-%d %H:%M:%S.%f}'" if since else ""
    return "(SELECT min(created_at) AS lower_bound, max(created_at) AS upper_bound FROM shipments" + where + ") AS b"


def split_options(lower: datetime | None, upper: datetime | None, num_partitions: int) -> dict[str, str]:
    """Reader options for ``num_partitions`` range slices of ``created_at``
    (bounds only steer the split; rows outside them are still read)."""
    if num_partitions <= 1:
        return {}
    if lower is None or upper is None:
        raise ValueError("a parallel JDBC scan needs the lowest and highest created_at")
    return {
        "partitionColumn": "created_at",
        "lowerBound": f"{lower:%Y-%m-%d %H:%M:%S}",
        "upperBound": f"{upper:%Y-%m-%d %H:%M:%S}",
        "numPartitions": str(num_partitions),
    }


def read_shipments_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    since: datetime | None = None,
    num_partitions: int = 64,
) -> DataFrame:
    """Parallel JDBC scan.  The split's bounds are one aggregate that the
    database computes, over the rows after ``since`` only."""
    jdbc = spark.read.format("jdbc").options(**options)
    lower, upper = jdbc.option("dbtable", shipment_bounds_query(since)).load().first()
    # No new rows: nothing to split, the scan returns none.
    split = split_options(lower, upper, num_partitions if lower is not None else 1)
    reader = spark.read.format("jdbc").options(**options).option("dbtable", shipments_query(since))
    return project_shipments(reader.options(**split).load())
