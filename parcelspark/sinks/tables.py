"""Warehouse tables that are replaced and appended at once.

A table is a folder of data folders, each filled by one Spark write, and a
pointer ``_current`` that lists those which make up the table.  A write fills
a new folder, then swaps the pointer, so readers see the old rows or the new
ones; a run that dies in between leaves a folder the pointer does not name.
One writer at a time: the jobs that own a table are its only writers.  The
folders of the version before stay for readers still on it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.sources.fs import delete_dir, list_dirs, path_exists, read_file, swap_file

CURRENT = "_current"


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Select the target's columns *by name* in its order and types, so an
    append can never shift or narrow a column (no positional inserts).
    Columns the frame lacks take their default (a Column) or NULL."""
    defaults = defaults or {}
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _folders(spark: SparkSession, table: str) -> list[str]:
    pointer = f"{table.rstrip('/')}/{CURRENT}"
    return json.loads(read_file(spark, pointer)) if path_exists(spark, pointer) else []


def exists(spark: SparkSession, table: str) -> bool:
    return bool(_folders(spark, table))


def data_paths(spark: SparkSession, table: str) -> list[str]:
    """Data folders of the table (none if it is absent)."""
    return [f"{table.rstrip('/')}/{f}" for f in _folders(spark, table)]


def read(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    paths = data_paths(spark, table)
    if not paths:
        raise FileNotFoundError(f"no committed table at {table}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def _write(df: DataFrame, table: str, keep_current: bool) -> int:
    """Write ``df`` and point the table at it; returns its row count (observed during the write)."""
    spark, table = df.sparkSession, table.rstrip("/")
    current = _folders(spark, table)
    folder = f"data-{uuid.uuid4().hex}"
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(f"{table}/{folder}")
    folders = [*current, folder] if keep_current else [folder]
    swap_file(spark, f"{table}/{CURRENT}", json.dumps(folders))  # <- commit
    for name in list_dirs(spark, table):
        if name.startswith("data-") and name not in folders and name not in current:
            delete_dir(spark, f"{table}/{name}")
    return int(obs.get["rows"])


def replace(df: DataFrame, table: str) -> int:
    """The table's rows become ``df``'s, all at once."""
    return _write(df, table, keep_current=False)


def append(df: DataFrame, table: str, schema: T.StructType, defaults: dict | None = None) -> int:
    """Add ``df``'s rows, columns matched by name."""
    return _write(conform(df, schema, defaults), table, keep_current=True)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Create an empty table with a fixed schema unless one exists."""
    if not exists(spark, table):
        replace(spark.createDataFrame([], schema), table)
