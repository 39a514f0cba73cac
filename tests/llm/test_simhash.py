import random

import numpy as np
from xxhash import xxh64_intdigest

from parcelspark.llm import simhash
from parcelspark.llm.queries import op10_simhash


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=4):
    """prints: (id, fp) -> {id: smallest id reachable}"""
    ids = [i for i, _ in prints]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, f) in enumerate(prints):
        for j, g in prints[:k]:
            if bin(f ^ g).count("1") <= most:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints_against_brute_force():
    rng = random.Random(2)
    texts = [None, "", " \n", "One", "one two three", "a b c d", "a b c d e", "É é x\xa0y Z\x0bq"]
    texts += [" ".join(rng.choice(["the", "of", "Aé", "zz"]) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint_of(t) == brute_print(t), repr(t)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint_of(long) == brute_print(long)


def test_thresholds_meet_the_pigeonhole_sum():
    p = np.full(64, 0.5)
    for n in (10, 10**5, 10**8, 10**11):
        for m in range(1, 6):
            together = np.outer(p, p) * n
            parts = simhash.group_bits(n, together, m)
            assert sorted(b for x in parts for b in x) == list(range(64))
            _, chosen = simhash.allocate(n, p, parts, 4)
            assert sum(chosen) == 4 - m + 1 and min(chosen) >= -1
    one = simhash.plan(10**11, np.outer(p, p) * 10**11)
    assert max(t for _, t in one) > 0  # few wide partitions at scale
    corr = np.outer(p, p) * 1000.0
    corr[0, 40] = corr[40, 0] = 500.0  # always set together
    assert any({0, 40} <= set(x) for x in simhash.group_bits(1000, corr, 4))


def test_links_lose_nothing(spark):
    rng = random.Random(9)
    prints = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(8):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, 6)):
                f ^= 1 << b
            prints.add(f)
    prints |= {0, 1, (1 << 64) - 1}
    rows = [(simhash._signed(f), i) for i, f in enumerate(sorted(prints))]
    df = spark.createDataFrame(rows, "fp long, id long")
    got = {(r.a, r.b) for r in simhash.links(df).collect()}
    mask = (1 << 64) - 1
    want = {(i, j) for f, i in rows for g, j in rows if f < g and bin((f ^ g) & mask).count("1") <= 4}
    assert got == want


def test_components_of_crowds_and_chains(spark):
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for spread in (2, 4, 5, 8):
        centre = rng.getrandbits(64)
        for _ in range(120):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, spread)):
                f ^= 1 << b
            prints.add(f)
    chain = rng.getrandbits(64)
    for k in range(0, 64, 4):
        prints.add(chain)
        chain ^= 0xF << k
    rows = [(simhash._signed(f), i) for i, f in enumerate(sorted(prints, key=lambda f: f * 7919 % 1009))]
    got = {r.fp: r.component_id for r in simhash.components(spark.createDataFrame(rows, "fp long, id long")).collect()}
    mask = (1 << 64) - 1
    want = brute_components([(i, f & mask) for f, i in rows])
    assert got == {f: want[i] for f, i in rows}


def test_odd_rows_and_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(5, None), (3, ""), (9, " "), (7, long), (8, long + " end"), (8, long + " end"), (2, "q r s"), (None, long), (2, "q r s")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "'c' as component_id", "2 as _gone_x")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (9, 3), (7, 7), (8, 7), (2, 2), (None, 7)}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 7]
    empty = simhash.near_duplicates(df.limit(0))
    assert empty.count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, brute_print(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_components(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op10_simhash(spark, sf).collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in rows}
    assert len(set(want.values())) < len(want)
