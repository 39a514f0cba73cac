"""Event ingest into the warehouse as a file stream: each event file once, full refreshes, a ledger.

The stream's checkpoint knows which files were read (by name; by path in a
nested layout), so no list of files ever reaches the driver.  A micro-batch is
committed by ``foreachBatch``:

    <events>/_generation=<g>/_batch=<b>   its files' events, written first
    <ledger>/_generation=<g>/_batch=<b>   a row per file, empty ones too; its success mark commits the batch

Both are overwritten, so a batch that is run again after a crash puts the same
rows in the same place; one whose ledger is there already is left alone.  The
checkpoint gives a batch id the same files each time.

A full refresh is a new generation: a fresh checkpoint and fresh folders,
filled by the same stream, then one swap of the pointer ``<ledger>/_current``.
A run that dies before the swap leaves the old generation current.

Each file is read as one text, so that an empty array is a row as well; the
export bounds the rows of a file.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark import schemas
from parcelspark.sources.fs import delete_dir, list_dirs, modified_at, path_exists, read_file, swap_file
from parcelspark.sources.tracking_json import EVENT_FILE_GLOB, RECORD_COLUMNS, file_key
from parcelspark.streaming.ingest import NEVER_TOO_OLD

GENERATION, BATCH = "_generation", "_batch"
_IS_EVENT = "_is_event"
_ROWS = T.StructType([
    *schemas.TRACKING_EVENTS.fields, T.StructField(_IS_EVENT, T.BooleanType()), T.StructField(BATCH, T.StringType())])


def _generations(spark: SparkSession, table: str) -> list[int]:
    return [int(n.split("=", 1)[1]) for n in list_dirs(spark, table) if n.startswith(f"{GENERATION}=")]


def _folder(table: str, generation: int, batch: str | None = None) -> str:
    path = f"{table.rstrip('/')}/{GENERATION}={generation}"
    return path if batch is None else f"{path}/{BATCH}={batch}"


def current_generation(spark: SparkSession, ledger: str) -> int | None:
    pointer = f"{ledger.rstrip('/')}/_current"
    return int(read_file(spark, pointer)) if path_exists(spark, pointer) else None


def committed_batches(spark: SparkSession, ledger: str, generation: int | None = None) -> tuple[int | None, list[str]]:
    """(generation, its committed micro-batches); the current generation unless one is given."""
    if generation is None:
        generation = current_generation(spark, ledger)
    if generation is None:
        return None, []
    folder = _folder(ledger, generation)
    names = [n.split("=", 1)[1] for n in list_dirs(spark, folder) if n.startswith(f"{BATCH}=")]
    return generation, sorted(b for b in names if path_exists(spark, f"{folder}/{BATCH}={b}/_SUCCESS"))


def _files(spark: SparkSession, events_dir: str, glob: str, recursive: bool, max_files: int | None) -> DataFrame:
    """Stream of whole files: (value, source_file)."""
    reader = (
        spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
        .option("fileNameOnly", not recursive).option("maxFileAge", NEVER_TOO_OLD)
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(events_dir).select("value", file_key(recursive).alias("source_file"))


def _event_rows(files: DataFrame) -> DataFrame:
    """A row per event, and one that is none for a file without events."""
    records = F.from_json("value", T.ArrayType(schemas.TRACKING_EVENT_RECORD), {"mode": "FAILFAST"})
    rows = files.select("source_file", F.explode_outer(records).alias("r"))
    return rows.select("r.*", "source_file", F.col("r").isNotNull().alias(_IS_EVENT))


def commit_batch(files: DataFrame, batch_id: int, events: str, ledger: str, generation: int) -> None:
    """Write a micro-batch's events, then its ledger rows; safe to repeat."""
    spark, batch = files.sparkSession, f"{batch_id:09d}"
    if path_exists(spark, f"{_folder(ledger, generation, batch)}/_SUCCESS"):
        return
    target = _folder(events, generation, batch)
    _event_rows(files).write.mode("overwrite").parquet(target)
    written = spark.read.schema(T.StructType(_ROWS.fields[:-1])).parquet(target)
    per_file = written.groupBy(F.col("source_file").alias("file_name")).agg(F.count_if(_IS_EVENT).cast("int").alias("row_count"))
    per_file.withColumn("ingested_at", F.localtimestamp()).write.mode("overwrite").parquet(_folder(ledger, generation, batch))


def _drain(spark: SparkSession, events_dir: str, events: str, ledger: str, generation: int,
           glob: str, recursive: bool, max_files: int | None) -> None:
    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, batch_id, events, ledger, generation)

    query = (
        _files(spark, events_dir, glob, recursive, max_files).writeStream.foreachBatch(commit)
        .option("checkpointLocation", f"{ledger.rstrip('/')}/_checkpoints/{GENERATION}={generation}")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def ingest_new_files(
    spark: SparkSession, events_dir: str, events: str, ledger: str, full_refresh: bool = False,
    glob: str = EVENT_FILE_GLOB, recursive: bool = False, max_files: int | None = None,
) -> dict:
    """Load every event file the current generation has not read yet; with ``full_refresh``, all into a new one.

    Without the events folder an incremental run does nothing and a full
    refresh leaves an empty table.
    """
    mode = "full_refresh" if full_refresh else "incremental"
    present = path_exists(spark, events_dir)
    generation = current_generation(spark, ledger)
    if not present and not full_refresh:
        return {"files_loaded": 0, "events_loaded": 0, "mode": mode}
    if full_refresh or generation is None:
        used = [*_generations(spark, events), *_generations(spark, ledger), *_generations(spark, f"{ledger.rstrip('/')}/_checkpoints")]
        target = max([-1 if generation is None else generation, *used]) + 1
    else:
        target = generation
    if generation is None and not full_refresh:  # the first load is readable batch by batch
        swap_file(spark, f"{ledger.rstrip('/')}/_current", str(target))
    _, before = committed_batches(spark, ledger, target)
    if present:
        _drain(spark, events_dir, events, ledger, target, glob, recursive, max_files)
    if full_refresh:
        swap_file(spark, f"{ledger.rstrip('/')}/_current", str(target))  # <- commit
    _, now = committed_batches(spark, ledger, target)
    loaded = _ledger(spark, ledger, target, sorted(set(now) - set(before)))
    files, rows = loaded.agg(F.count(F.lit(1)), F.sum("row_count")).first()
    return {"files_loaded": files, "events_loaded": int(rows or 0), "mode": mode}


def _ledger(spark: SparkSession, ledger: str, generation: int | None, batches: list[str]) -> DataFrame:
    schema = T.StructType([*schemas.INGESTED_FILES.fields, T.StructField(BATCH, T.StringType())])
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(ledger, generation)).where(F.col(BATCH).isin(batches))


def current_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(file_name, row_count, ingested_at): one row per processed file."""
    return _ledger(spark, ledger, *committed_batches(spark, ledger)).drop(BATCH)


def read_event_batches(spark: SparkSession, events: str, generation: int | None, batches: list[str]) -> DataFrame:
    """Events of the given micro-batches only (a partition filter)."""
    if not batches:
        return spark.createDataFrame([], schemas.TRACKING_EVENTS)
    rows = spark.read.schema(_ROWS).parquet(_folder(events, generation))
    return rows.where(F.col(BATCH).isin(batches) & F.col(_IS_EVENT)).select(*RECORD_COLUMNS, "source_file")


def read_events_table(spark: SparkSession, events: str, ledger: str) -> DataFrame:
    """raw.tracking_events: the committed micro-batches of the current generation."""
    return read_event_batches(spark, events, *committed_batches(spark, ledger))


def vacuum(spark: SparkSession, events: str, ledger: str, grace_hours: int = 24, now: datetime | None = None) -> list[int]:
    """Delete the generations before the current one once that has been current for ``grace_hours``.

    Readers of an older one have had that long; a later one is a refresh in flight.
    """
    generation = current_generation(spark, ledger)
    if generation is None:
        return []
    since = modified_at(spark, f"{ledger.rstrip('/')}/_current")
    if ((now or datetime.now(timezone.utc).replace(tzinfo=None)) - since).total_seconds() < grace_hours * 3600:
        return []
    old = sorted({g for t in (events, ledger) for g in _generations(spark, t) if g < generation})
    for g in old:
        for path in (_folder(events, g), _folder(ledger, g), _folder(f"{ledger.rstrip('/')}/_checkpoints", g)):
            delete_dir(spark, path)
    return old
