import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from parcelspark.llm import trie
from parcelspark.llm.common import table
from parcelspark.llm.queries import op11_trie, rebuilt


def signed_hash(role, text):
    h = xxh64_intdigest(text.encode(), xxh64_intdigest(role.encode(), 42))
    return h - (1 << 64) if h >> 63 else h


def brute_conversations(rows):
    """{conv_id: [(role, text), ...]} in order."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, signed_hash(role, text), role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}


def brute_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_nodes(built):
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for a in range(len(p) + 1):
            leaves[p[:a]] += not children[p]
            saved[p[:a]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    rows = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return order(rows)


def order(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[3:]))


def sample_rows(rng, n, deep=9):
    """Conversations that share first turns, also whole copies and prefixes of others."""
    rows, made = [], [[]]
    for c in range(n):
        turns = list(rng.choice(made)) if rng.random() < 0.7 else []
        turns = turns[: rng.randint(0, len(turns))] if rng.random() < 0.5 else turns
        turns += [(rng.choice(["user", "assistant"]), rng.choice("abcé") * rng.randint(0, 2)) for _ in range(rng.randint(0, deep))]
        made.append(turns)
        rows += [(c * rng.choice([1, 1, 7]) + 3, i, *t) for i, t in enumerate(turns or [("user", "x")])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")


def found(spark, df, segment=trie.SEGMENT, rebuild=True):
    turns = trie.turn_codes(df)
    turns, convs = rebuilt(turns) if rebuild else (turns, turns.select("conv_id").distinct())
    nodes, ends = trie.prefix_trie(turns, convs, segment)
    digests = trie.end_digests(ends).withColumnRenamed("e1", "id1").withColumnRenamed("e2", "id2")
    out = nodes.join(digests, ["id1", "id2"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return order([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, r.sha or empty) for r in out.collect()])


def random_parens(rng, pairs):
    bits, depth = [], 0
    while len(bits) < 2 * pairs:
        left = 2 * pairs - len(bits)
        up = depth == 0 or (depth < left and rng.random() < rng.choice([0.3, 0.5, 0.7]))
        bits.append(int(up))
        depth += 1 if up else -1
    return np.array(bits)


def test_findclose_and_ranks():
    rng = random.Random(1)
    shapes = [random_parens(rng, rng.randint(1, 900)) for _ in range(60)]
    shapes += [np.array([1] * 700 + [0] * 700), np.tile([1, 0], 700), np.array([1, *[1, 0] * 600, 0])]
    for bits in shapes:
        stack, close = [], {}
        for i, b in enumerate(bits.tolist()):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        p = trie.BalancedParens(bits)
        at = np.flatnonzero(bits)
        assert p.findclose(at).tolist() == [close[i] for i in at.tolist()]
        assert p.pairs_before[-1] == sum(close[i] == i + 1 for i in close)
        assert p.depth() == max(np.cumsum(np.where(bits, 1, -1)))


def test_range_min():
    rng = np.random.default_rng(2)
    v = rng.integers(-99, 99, 300)
    a = rng.integers(0, 299, 500)
    b = a + 1 + (rng.random(500) * (300 - a)).astype(int).clip(0, 299 - a)
    assert trie.RangeMin(v)(a, b).tolist() == [v[x:y].min() for x, y in zip(a, b)]


@pytest.mark.parametrize("segment", [trie.SEGMENT, 3])
def test_against_brute_force(spark, segment):
    rows = sample_rows(random.Random(segment), 120)
    df = frame(spark, rows).repartition(3)
    own = brute_conversations(rows)
    assert found(spark, df, segment, rebuild=False) == brute_nodes(own)
    assert found(spark, df, segment) == brute_nodes(brute_rebuilt(own))


def test_many_small_shards(spark):
    """Spines that several shards share, down to one path a shard."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(5)
        rows = [(c, i, "u", t) for c in range(40) for i, t in enumerate(["hot"] * rng.randint(1, 4) + [rng.choice("xy") for _ in range(rng.randint(0, 5))])]
        for n in ("23", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for segment in (2, trie.SEGMENT):
                assert found(spark, frame(spark, rows), segment, rebuild=False) == brute_nodes(brute_conversations(rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, sf, "conversations").collect()]
    got = order([tuple(r) for r in op11_trie(spark, sf).collect()])
    assert got == brute_nodes(brute_rebuilt(brute_conversations(rows)))


def test_odd_rows(spark, tmp_path):
    long = [(200, i, "user", f"t{i % 3}") for i in range(300)]
    rows = [(100, 0, "user", "a"), (100, None, None, None), (100, None, "user", None), (100, 0, "user", "a"), (100, 0, "user", "b"),
            (101, 5, "x", "é" * 9), (101, 5, "x", "é" * 9), (None, 1, "user", "lost"), (103, 1, "", ""), (7, 1, "user", "w " * 50_000), *long]
    df = frame(spark, rows).selectExpr("*", "1 as at", "'x' as x1", "2 as part")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    out = op11_trie(spark, str(tmp_path))
    assert order([tuple(r) for r in out.collect()]) == brute_nodes(brute_rebuilt(brute_conversations(rows)))
    df.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    none = op11_trie(spark, f"{tmp_path}/none")
    assert none.collect() == [] and none.columns == out.columns
