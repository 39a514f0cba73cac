"""Sharding by a permutation-filled lookup table (DataFrame functions only).

Every shard walks the slots of a prime-sized table in its own order: start and
stride come from hashes of its name, and a prime size makes any stride visit
all slots.  Shards take turns; each turn claims the shard's next free slot (a
shard of weight w has w turns a round).  So shares are even to within a turn,
and when a shard leaves or joins most slots keep their owner.

A row's slot is the hash of its key modulo the table size.  The table has
``slots`` rows whatever the data, so it is broadcast and placement takes
constant time.

Defined results: a null key is placed like the text "null"; repeated keys
share a shard; shard names must be distinct and their number at most a
hundredth of the slots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.common import fresh

SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> list[int]:
    """Owner (index into ``shards``) of each slot."""
    if not _is_prime(slots):
        raise ValueError("the table size must be prime")
    if not shards or len(set(shards)) < len(shards) or len(shards) * 100 > slots:
        raise ValueError("shards must be named, distinct and at most a hundredth of the slots")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("one weight of 1 or more for each shard")
    walks = []
    for name in shards:
        h = hashlib.md5(name.encode()).digest()
        walks.append([int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:], "big") % (slots - 1) + 1])
    owner, free = [-1] * slots, slots
    while free:
        for k, (walk, turns) in enumerate(zip(walks, weights)):
            for _ in range(min(turns, free)):
                at, stride = walk
                while owner[at] >= 0:
                    at = (at + stride) % slots
                owner[at] = k
                walk[0] = (at + stride) % slots
                free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 15 hex digits of its text's MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots))


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS,
                 weights: Sequence[int] | None = None) -> DataFrame:
    """(slot, shard, shard_name): exactly ``slots`` rows."""
    owners = F.from_json(F.lit("[" + ",".join(map(str, fill(shards, slots, weights))) + "]"), "array<int>")
    names = F.array(*[F.lit(s) for s in shards])
    table = spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))
    return table.select(F.col("slot").cast("long").alias("slot"), "shard", F.get(names, "shard").alias("shard_name"))


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS,
          weights: Sequence[int] | None = None) -> tuple[DataFrame, str]:
    """``df`` plus one struct column (slot, shard, shard_name); its name."""
    table = lookup_table(df.sparkSession, shards, slots, weights)
    table = table.select(F.col("slot").alias("_slot"), F.struct("slot", "shard", "shard_name").alias("_place"))
    name = fresh(df, "placement")
    met = slot_of(df[key], slots) == table["_slot"]
    return df.join(F.broadcast(table), met, "left").select(*[df[c] for c in df.columns], F.col("_place").alias(name)), name


def write(df: DataFrame, key: str, shards: Sequence[str], path: str, files_per_shard: int = 8) -> None:
    """One folder per shard; a shard's rows are dealt over ``files_per_shard`` tasks, so none takes a whole shard."""
    placed, name = place(df, key, shards)
    salt, folder = fresh(placed, "file"), fresh(placed, "shard")
    out = placed.withColumn(folder, F.col(name)["shard_name"]).withColumn(
        salt, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard)))
    out.repartition(folder, salt).drop(name, salt).write.partitionBy(folder).parquet(path)
