"""Catalog introspection over warehouse tables: tables and typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("ordinal_position", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
])


def register_tables(spark: SparkSession, tables: dict[str, str]) -> None:
    """Expose parquet tables (name -> path) as temporary views."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def catalog_columns(spark: SparkSession, tables: list[str] | None = None) -> DataFrame:
    """(table, ordinal, column, type) ordered by table and ordinal.

    Metadata only: one row per column of each table, built from the catalog
    on the driver (its size is the schema, not the data).
    """
    rows = []
    for name in tables or list_tables(spark):
        for i, col in enumerate(spark.catalog.listColumns(name), start=1):
            rows.append((name, i, col.name, col.dataType))
    return spark.createDataFrame(rows, COLUMNS_SCHEMA).orderBy("table_name", "ordinal_position")
