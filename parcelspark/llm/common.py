"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The six characters [\x20\x09-\x0D], the only white space of the contracts.
BLANKS = " \t\n\x0b\x0c\r"
#: Tables of at most this size may be broadcast.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``."""
    if _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        sc.environment["PYTHONPATH"] = _ROOT
        return
    done = getattr(sc, "_parcelspark_shipped", False)
    if not done:
        import shutil
        import tempfile

        # The zip is served to the executors by Spark's own file server.
        base = os.path.join(tempfile.mkdtemp(prefix="parcelspark-code-"), "parcelspark")
        sc.addPyFile(shutil.make_archive(base, "zip", _ROOT, "parcelspark"))
        sc._parcelspark_shipped = True


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; texts that are all ASCII take the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage)."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """Bytes that ``value`` counts for: texts their length, nested values the sum of their parts, others 16."""
    if kind.typeName() in ("string", "binary"):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType):
        if kind.elementType.typeName() in ("string", "binary") or isinstance(kind.elementType, (T.ArrayType, T.MapType, T.StructType)):
            parts = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + 16 + _bytes_of(x, kind.elementType))
        else:
            parts = 16 * F.size(value).cast("long")
        return 16 + F.when(value.isNull(), F.lit(0)).otherwise(parts).cast("long")
    if isinstance(kind, T.MapType):
        return _bytes_of(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes_of(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        return sum((_bytes_of(value[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
    return F.lit(16).cast("long")


def broadcast_if_small(df: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast`` for a materialized frame whose measured rows and bytes fit.

    One aggregate; only two numbers reach the driver.  Beyond the bounds the
    join stays a shuffle join.
    """
    width = sum((_bytes_of(df[f.name], f.dataType) for f in df.schema.fields), F.lit(0).cast("long"))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    fits = rows <= most_rows and (size or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


class WordCache(dict):
    """Bounded memo of ``make(word)``: two generations, so hot words survive a turn-over.

    Holds at most ``2 * limit`` entries.  Keys longer than ``max_len`` are
    computed each time, so the memory is bounded too.
    """

    def __init__(self, make: Callable, limit: int = 150_000, max_len: int = 64):
        super().__init__()
        self.make, self.limit, self.max_len, self.old = make, limit, max_len, {}

    def __missing__(self, word):
        if len(word) > self.max_len:
            return self.make(word)
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def hash_sample(rows: DataFrame, wanted: int, size: int) -> DataFrame:
    """About ``wanted`` of the ``size`` rows: those whose ``doc_id`` has a low hash, found without a sort; all if fewer."""
    spot = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(spot < wanted / max(size, 1))


def crc_fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 3 (fold 1 is held out)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def connected_components(edges: DataFrame, purpose: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): smallest node reachable over undirected ``edges`` (a, b).

    Min-label propagation with pointer jumping.  Each round is written to the
    shared folder; only a count of changed labels reaches the driver.  Nodes
    are any orderable type; nodes without an edge do not appear.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    both = materialize(both, f"{purpose}-edges")
    label = both.groupBy(F.col("src").alias("node")).agg(F.least(F.first("src"), F.min("dst")).alias("lab"))
    label = materialize(label, f"{purpose}-labels")
    for _ in range(max_rounds):
        # The smallest label around, the own one included ...
        none = F.lit(None).cast(label.schema["lab"].dataType)
        heard = both.join(label, both["dst"] == label["node"]).select(F.col("src").alias("node"), "lab", none.alias("was"))
        own = label.select("node", "lab", F.col("lab").alias("was"))
        step = heard.unionByName(own).groupBy("node").agg(F.min("lab").alias("near"), F.min("was").alias("was"))
        # ... and that one's own label: paths halve each round.
        up = label.select(F.col("node").alias("up"), F.col("lab").alias("up_lab"))
        step = step.join(up, step["near"] == up["up"], "left").select("node", "was", F.least("near", "up_lab").alias("lab"))
        step = materialize(step, f"{purpose}-round")
        label = step.select("node", "lab")
        if step.filter("lab < was").isEmpty():
            return label.select("node", F.col("lab").alias("component"))
    raise RuntimeError("components did not converge; raise max_rounds")
