import hashlib
from collections import Counter

import pytest

from parcelspark.llm import shards
from parcelspark.llm.queries import SHARD_NAMES, op3_sharding


def brute_fill(names, slots):
    orders = []
    for n in names:
        h = hashlib.md5(n.encode()).digest()
        at, by = int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:], "big") % (slots - 1) + 1
        orders.append(iter([(at + j * by) % slots for j in range(slots)]))
    owner = {}
    while len(owner) < slots:
        for k, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(s for s in order if s not in owner)] = k
    return [owner[s] for s in range(slots)]


def test_fill_against_brute_force():
    names = [f"n{i}" for i in range(7)]
    assert shards.fill(names, 1009) == brute_fill(names, 1009)
    assert shards.fill(["only"], 101) == [0] * 101


def test_even_shares_and_little_disruption():
    before = shards.fill(SHARD_NAMES)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = shards.fill(SHARD_NAMES[:-1])
    moved = sum(a != b for a, b in zip(before, after) if b != len(SHARD_NAMES) - 1 and a != len(SHARD_NAMES) - 1)
    assert moved < 0.1 * len(before)
    weighted = Counter(shards.fill(["a", "b"], 1009, [3, 1]))
    assert abs(weighted[0] / weighted[1] - 3) < 0.05


def test_bad_tables_are_refused():
    for names, slots in ((["a"], 100), ([], 101), (["a", "a"], 1009), (["a", "b"], 101)):
        with pytest.raises(ValueError):
            shards.fill(names, slots)


def test_query_against_brute_force(spark):
    owner = shards.fill(SHARD_NAMES)
    rows = op3_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for r in rows:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % shards.SLOTS
        assert (r.slot, r.shard, r.shard_name) == (slot, owner[slot], SHARD_NAMES[owner[slot]])


def test_odd_rows_and_writing(spark, tmp_path):
    df = spark.createDataFrame([(None, "a", 1), ("", "b", 2), ("x" * 10**5, "c", 3), ("k", "d", 4), ("k", "d", 4)],
                               "key string, placement string, shard int")
    out, name = shards.place(df, "key", ["s0", "s1", "s2"], 1009)
    assert name == "placement_1" and out.columns[:-1] == df.columns and out.count() == 5
    assert out.where("key = 'k'").select(f"{name}.shard").distinct().count() == 1
    assert shards.place(df.limit(0), "key", ["s0"], 1009)[0].count() == 0
    shards.write(df, "key", ["s0", "s1", "s2"], str(tmp_path / "w"), 2)
    assert spark.read.parquet(str(tmp_path / "w")).count() == 5
