"""Hourly JSON event files: one JSON *array* of flat records per file.

* read: explicit schema (missing fields -> NULL, unknown fields dropped),
  ``multiLine`` (a top-level array yields one row per element), FAILFAST on
  malformed input, provenance from the file-metadata column;
* listing: the ``binaryFile`` source without its content column, i.e. a
  distributed listing of (path, length) that never reads file bodies;
* exactly-new files: listing LEFT ANTI ledger on the file *name*.  The jobs'
  ingest (``streaming/event_table.py``) leaves that to the stream's checkpoint.

A multi-line JSON file is not splittable (one file = one task); hourly files
keep that bounded, and the export side caps records per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark import schemas

EVENT_FILE_GLOB = "events_*.json"
RECORD_COLUMNS = [f.name for f in schemas.TRACKING_EVENT_RECORD.fields]


def read_event_files(
    spark: SparkSession,
    paths: str | list[str],
    glob: str | None = EVENT_FILE_GLOB,
    recursive: bool = False,
    key_by_path: bool | None = None,
) -> DataFrame:
    reader = (
        spark.read.schema(schemas.TRACKING_EVENT_RECORD)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.json(paths)
    by_path = recursive if key_by_path is None else key_by_path
    return df.select(*RECORD_COLUMNS, file_key(by_path).alias("source_file"))


def file_key(recursive: bool):
    """Identity of an input file: its name in a flat feed (moving the folder
    does not re-ingest), its full path in a nested, Spark-written layout
    (where part-file names repeat across partition folders)."""
    return F.col("_metadata.file_path") if recursive else F.col("_metadata.file_name")


def list_event_files(spark: SparkSession, events_dir: str, glob: str = EVENT_FILE_GLOB,
                     recursive: bool = False) -> DataFrame:
    """(file_name, path, length) of matching files; bodies are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    name = F.col("path") if recursive else F.element_at(F.split(F.col("path"), "/"), -1)
    return reader.load(events_dir).select(
        name.alias("file_name"),
        "path",
        "length",
    )


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose *name* is not in the ledger (content/mtime changes ignored)."""
    return listing.join(ledger.select("file_name"), "file_name", "left_anti")
