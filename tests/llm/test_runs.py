import hashlib
import random
import re
import zlib

import numpy as np

from parcelspark.llm import runs
from parcelspark.llm.queries import op13_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(ws, least=24):
    """Every run by comparing all words at all distances."""
    n, out = len(ws), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            s, e = i, j + q
            i = j
            if e - s < max(least, 3 * q):
                continue
            if not any(all(ws[k] == ws[k + r] for k in range(s, e - r)) for r in range(1, q)):
                out.append((s, e, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_altered(doc_id, ws):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(ws)
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text, found=None):
    ws = brute_altered(doc_id, WORD.findall(text or "")) if doc_id is not None else WORD.findall(text or "")
    found = brute_runs(ws)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = None
    for s, e, q in found:
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    s, n, q = best or (None, None, None)
    return (doc_id, len(found), s, n, q, None if s is None else 1000 * n // q,
            sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)),
            sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def sample_words(rng, most):
    w = []
    while len(w) < rng.randint(20, most):
        if rng.random() < 0.5:
            w += [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(rng.randint(1, 40))]
        else:
            p = [rng.randint(0, 3) for _ in range(rng.randint(1, 40))]
            w += (p * 7)[: rng.randint(1, 6 * len(p))]
    return w


def test_transform_is_a_convolution():
    rng = np.random.default_rng(3)
    for n in (2, 8, 64):
        for prime, root in runs.PRIMES:
            a, b = rng.integers(0, prime, (2, 3, n)).astype(np.uint64)
            assert (runs.inverse_ntt(runs.ntt(a, prime, root), prime, root) == a).all()
            got = runs.inverse_ntt(runs.ntt(a, prime, root) * runs.ntt(b, prime, root) % np.uint64(prime), prime, root)
            for x, y, z in zip(a.tolist(), b.tolist(), got.tolist()):
                assert z == [sum(x[i] * y[(k - i) % n] for i in range(n)) % prime for k in range(n)]


def test_block_matches_against_comparison():
    rng = np.random.default_rng(4)
    for size, near, far in ((8, 1, 15), (16, 16, 31), (64, 64, 127)):
        x = rng.integers(0, 2, 600)
        x[100:400] = np.tile(x[100:110], 30)
        x = np.concatenate([x, np.full(3 * size, 9)])
        at = np.arange(0, 600 // size * size, size)
        got = set(zip(*(v.tolist() for v in runs.block_matches(x, at, size, near, far))))
        assert got == {(i, q) for i, p in enumerate(at.tolist()) for q in range(near, far + 1)
                       if (x[p : p + size] == x[p + q : p + q + size]).all()}


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        w = sample_words(rng, 400)
        assert runs.find_runs(np.array([*w, 10**6])) == brute_runs(w)
    w = [1, 2, 3] * 8  # exactly 24 words
    assert runs.find_runs(np.array(w)) == [(0, 24, 3)] and runs.find_runs(np.array(w[:-1])) == []
    assert runs.find_runs(np.zeros(0, np.int64)) == []


def test_long_texts_and_long_periods():
    rng = random.Random(2)
    period = [rng.randint(0, 500) for _ in range(5_000)]
    w = [rng.randint(0, 500) for _ in range(777)] + period * 3 + [501]
    found = runs.find_runs(np.array(w))
    assert [r for r in found if r[2] == 5_000] and all(w[s : e - q] == w[s + q : e] for s, e, q in found)
    assert runs.find_runs(np.array([7] * 50_000)) == [(0, 50_000, 1)]


def test_query_against_brute_force(spark):
    from parcelspark.llm.common import table

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r) for r in op13_runs(spark, sf).collect()}
    want = {r.doc_id: brute_row(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()}
    assert got == want and any(r[1] for r in want.values())


def test_odd_rows(spark, tmp_path):
    ha = "\n\tha " * 30 + "\x0b"
    rows = [(1, None), (2, ""), (3, " \x0b"), (4, ha), (4, ha), (5, "é x\xa0y " * 9), (None, ha), (6, "a b " * 20_000), (7, "one")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, runs string, start int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = op13_runs(spark, str(tmp_path))
    key = lambda r: (r[0] is None, r)
    small = [r for r in rows if r[0] != 6]
    assert sorted([tuple(r) for r in out.collect() if r.doc_id != 6], key=key) == sorted([brute_row(*r) for r in small], key=key)
    long = out.where("doc_id = 6").first()
    assert long.n_runs == 1 and long.length * 1000 // long.period == long.exponent_milli
    assert op13_runs(spark, str(tmp_path)).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                       "runs_sha256", "collapsed_sha256"]
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_runs(spark, f"{tmp_path}/none").collect() == []
