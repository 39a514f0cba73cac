"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A *run* is a set of (h1, h2, n_docs, keeper) rows, one per line key, sorted by
the 128-bit key hash: in how many documents of its batches the key occurs and
the largest ``doc_id`` that holds it.  A batch of documents adds one run to
level 0; whenever a level holds ``fanout`` runs they are merged into one run of
the next level and deleted.  A batch's lines are merge-joined with the runs:
the anti side are the lines that survive, the semi side those that go.

Defined results: a null or empty text is one empty line; a key is counted once
per distinct ``doc_id``; rows that share a ``doc_id`` are one document and all
keep the lines it is the keeper of; rows without a ``doc_id`` neither count nor
lose lines; very long texts are split whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.common import BLANKS, ascii_lower, broadcast_if_small, fresh, materialize
from parcelspark.session import scratch_dir

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 4


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(batch, doc_id, row, keys): per row of ``docs`` its long lines' numbers and key hashes."""
    trimmed = F.filter(
        F.transform(split_lines(F.col("text")), lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(BLANKS)).alias("key"))),
        lambda s: F.length(s["key"]) >= min_chars,
    )
    lower = F.transform(trimmed, lambda s: F.struct(s["i"].alias("i"), ascii_lower(s["key"]).alias("key")))
    keys = F.transform(lower, lambda s: F.struct(
        s["i"].alias("i"), F.xxhash64(s["key"]).alias("h1"), F.xxhash64(F.lit(7), s["key"]).alias("h2")))
    return docs.where("doc_id is not null").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"), "doc_id",
        F.xxhash64("text").alias("row"), keys.alias("keys"),
    ).where(F.size("keys") > 0)


class LineRuns:
    """The levelled store under a folder of the shared file system."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = [[]]
        self.written = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.folder}/level{level}-run{self.written}"
        self.written += 1
        rows.sortWithinPartitions("h1", "h2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        return (
            self.spark.read.parquet(*paths).groupBy("h1", "h2")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        )

    def add(self, batch: DataFrame) -> None:
        """Add a batch of ``line_hashes`` whose documents are in no earlier batch."""
        distinct = F.array_distinct(F.transform("keys", lambda k: F.struct(k["h1"].alias("h1"), k["h2"].alias("h2"))))
        per_doc = batch.select("doc_id", F.explode(distinct).alias("k")).select("k.h1", "k.h2", "doc_id")
        # Rows may share a doc_id: the inner grouping, dealt by all three, keeps a hot key's documents spread.
        run = per_doc.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("rows")).groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        self._write(run, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            self._write(self._merged(old), level + 1)
            self.levels[level] = []
            self._delete(old)
            level += 1

    def _delete(self, paths: list[str]) -> None:
        jvm = self.spark._jvm
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def entries(self) -> DataFrame:
        """All runs merged: one row per key."""
        paths = [p for level in self.levels for p in level]
        if len(paths) == 1:
            return self.spark.read.parquet(paths[0])
        return self._merged(paths)

    def frequent(self, min_docs: int) -> DataFrame:
        return self.entries().where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")

    def _lines(self, batch: DataFrame) -> DataFrame:
        return batch.select("doc_id", "row", F.explode("keys").alias("k")).select("doc_id", "row", "k.i", "k.h1", "k.h2")

    def _split(self, batch: DataFrame, min_docs: int, how: str) -> DataFrame:
        a, b = self._lines(batch).alias("a"), self.frequent(min_docs).alias("b")
        met = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")) & (F.col("a.doc_id") != F.col("b.keeper"))
        return a.join(b.hint("merge"), met, how)

    def survivors(self, batch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc_id, row, i, h1, h2) of the long lines that the merge-anti-join leaves."""
        return self._split(batch, min_docs, "left_anti")

    def dropped(self, batch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """The complement: lines whose key is frequent and kept elsewhere."""
        return self._split(batch, min_docs, "left_semi")


def find_dropped(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, row, dropped): line numbers to drop, only for rows that lose any."""
    spark = docs.sparkSession
    hashed = scratch_dir(spark, "line-hashes")
    rows = line_hashes(docs, min_chars, batches)
    rows.write.partitionBy("batch").parquet(hashed)
    hashes = spark.read.schema(rows.schema).parquet(hashed)
    runs = LineRuns(spark, scratch_dir(spark, "line-runs"), fanout)
    for b in range(batches):
        runs.add(hashes.where(F.col("batch") == b))
    drops = (
        runs.dropped(hashes, min_docs).groupBy("doc_id", "row")
        .agg(F.collect_set("i").alias("dropped"))
    )
    return materialize(drops, "line-drops")


def dedup(docs: DataFrame, **options) -> tuple[DataFrame, str]:
    """``docs`` plus one struct column (n_lines, n_dropped, kept text); its name.

    The rows that lose lines are few and small beside the texts: their table is
    broadcast if its measured size allows, else shuffle-joined.
    """
    drops = broadcast_if_small(find_dropped(docs, **options))
    drops = drops.select(F.col("doc_id").alias("_of"), F.col("row").alias("_row"), F.col("dropped").alias("_dropped"))
    hit = F.col("_dropped")
    # The one-element array binds the split lines once, so that each is fetched in constant time.
    kept = F.transform(F.array(split_lines(F.col("text"))), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), hit), lambda i: F.get(lines, i)), "\n"))[0]
    name = fresh(docs, "line_result")
    out = docs.join(drops, (docs["doc_id"] == F.col("_of")) & (F.xxhash64(docs["text"]) == F.col("_row")), "left")
    result = F.struct(
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size(hit), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(hit.isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
    return out.select(*[docs[c] for c in docs.columns], result.alias(name)), name
