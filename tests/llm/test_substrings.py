import hashlib
import random
import re

import pytest

from parcelspark.llm import substrings
from parcelspark.llm.common import table
from parcelspark.llm.queries import op12_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    """[(doc_id, n_words, n_removed, kept)] by looking every window up."""
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, ws in split:
        if i is not None:
            for s in range(len(ws) - window + 1):
                k = tuple(ws[s : s + window])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, ws in split:
        gone = set()
        for s in range(len(ws) - window + 1):
            if i is not None and first[tuple(ws[s : s + window])] < i:
                gone |= set(range(s, s + window))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def results(docs, **options):
    out, name = substrings.dedup(docs, **options)
    return order([(r.doc_id, *r[name]) for r in out.collect()])


def shared_texts(rng, n, most=120):
    """Texts that share passages of all lengths, near copies, and words that repeat inside a text."""
    pool = [[str(rng.randint(0, 60)) for _ in range(rng.randint(5, most))] for _ in range(12)]
    texts = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.6:
                p = rng.choice(pool)
                a = rng.randint(0, len(p) - 1)
                w += p[a : a + rng.randint(1, most)]
            else:
                w += [rng.choice(["a", "b"]) for _ in range(rng.randint(1, 30))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    return texts


def test_levels():
    assert substrings.levels(13) == [7, 13] and substrings.levels(52) == [7, 13, 26, 52]
    assert substrings.levels(50) == [7, 13, 25, 50] and substrings.levels(5) == [5]
    for w in range(1, 300):
        n = substrings.levels(w)
        assert n[-1] == w and all(b <= 2 * a for a, b in zip(n, n[1:]))


@pytest.mark.parametrize("window", [13, 52, 5])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    rows = [(rng.randint(0, 10**6), t) for t in shared_texts(rng, 150)]
    rows += [(rng.randint(0, 10**6), rng.choice(rows)[1]) for _ in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert results(docs, window=window) == order(brute(rows, window))


def test_without_broadcasts_and_with_hot_entries(spark, monkeypatch):
    rng = random.Random(9)
    hot = " ".join(f"h{i}" for i in range(30))
    rows = [(i, f"{t} {hot}" if i % 3 else t) for i, t in enumerate(shared_texts(rng, 120, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substrings, "BROADCAST_GRAMS", 0)
    monkeypatch.setattr(substrings, "HOT", 100)
    monkeypatch.setattr(substrings, "broadcast_if_small", lambda df, *_: df)
    assert results(docs) == order(brute(rows))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    want = {i: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in brute(rows)}
    assert {r[0]: tuple(r)[1:] for r in op12_substrings(spark, sf).collect()} == want
    assert any(gone for _, gone, _ in want.values())


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    passage = "é " + " ".join(f"p{i}" for i in range(13))
    rows = [(1, None), (2, ""), (3, "\n \x0b"), (4, passage), (4, passage), (5, f"x {passage}\x0cy"), (None, passage), (0, None),
            (6, long), (7, long + " end"), (8, long), (9, "short"), (10, "short"), (11, "a " * 400), (12, "a " * 12), (13, "a " * 13),
            (4, "one " + passage), (14, "x\xa0y " + passage)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, _d int, substring_result string")
    out, name = substrings.dedup(docs)
    assert out.columns == [*docs.columns, name] and name == "substring_result_1"
    assert order([(r.doc_id, *r[name]) for r in out.collect()]) == order(brute(rows))
    none, name = substrings.dedup(docs.limit(0))
    assert none.collect() == []
    assert results(docs.where("doc_id in (9, 2)")) == [(2, 0, 0, ""), (9, 1, 0, "short")]
