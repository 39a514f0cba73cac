import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelspark.llm import gbt, quality
from parcelspark.llm.queries import op6_quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    hit, often = set(), Counter(grams)
    for i, g in enumerate(grams):
        if often[g] > 1:
            hit |= {i, i + 1, i + 2}
    dups = sum(n - 1 for x, n in Counter(text.split("\n")).items() if re.search(r"[^\x20\x09-\x0D]", x))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit))


CASES = [None, "", " \n\t", "a a a a", "a\nb\na\n \n \nb", "x\x0by\x0cz\r\nx", "é é é é ##|", "a\xa0b  c",
         "one two three one two three four", "w " * 5]


def test_base_counts_against_brute_force():
    rng = random.Random(1)
    texts = CASES + ["".join(rng.choice("ab é\n\r#$") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for t in texts:
        assert quality.measure(t)[:5] == brute(t), repr(t)
    wide = " ".join(f"w{i % 1500}" for i in range(4000))
    assert quality.measure(wide)[:5] == (4000, brute(wide)[1], 0, 0, 4000)


def test_very_many_distinct_words_use_the_two_step_codes():
    words = [str(i) for i in range((1 << 20) + 5)]
    assert quality.repeated_words(words + words[:3])[0] == 6


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(3000) < 0.1)).astype(float)
    y[x[:, 0] > 0.9] = 1  # a wrong turn that the constraint must not follow
    model = gbt.fit(x, y, np.array([-1, 0, 0]))
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    p = model.probability(grid).reshape(50, 40)
    assert (np.diff(p, axis=1) <= 1e-12).all()
    assert ((model.probability(x) > 0.5) == (x[:, 0] < 0.5))[x[:, 0] < 0.85].mean() > 0.95
    slow = [model.base + sum(_walk(model, r, v) for r in model.roots) for v in x[:50]]
    assert np.allclose(slow, model.margin(x[:50]))
    assert np.allclose(gbt.fit(x[:0], y[:0], np.zeros(3)).probability(x[:2]), 0.5)


def _walk(m, node, v):
    while m.left[node] != node:
        node = m.right[node] if v[m.feature[node]] > m.threshold[node] else m.left[node]
    return m.value[node]


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.01"


def test_query_and_held_out_accuracy(spark, sf):
    rows = op6_quality(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert max(map(len, texts.values())) > 20_000
    for r in rows:
        assert tuple(r[c] for c in quality.BASE) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    judged, name = quality.judge(docs, model)
    held = judged.join(labels.where("doc_id % 2 = 1"), "doc_id").select(f"{name}.*", "quality").collect()
    right = [(r.score >= 0.5) == (r.quality == 1) for r in held]
    assert sum(right) / len(right) > 0.95
    assert sum(r.score >= quality.KEEP_AT for r in held if r.quality) >= 0.99 * sum(r.quality for r in held)


def test_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, "a " * 60, "y"), (None, "", "z")], "doc_id long, text string, quality_result string")
    model = quality.train(docs, labels)
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns
    judged, name = quality.judge(docs, model)
    assert name == "quality_result_1" and judged.count() == 3
    assert quality.keep(docs.limit(0), quality.train(docs.limit(0), labels.limit(0))).count() == 0


def test_one_python_function_a_task(spark):
    """A second one would double the Python workers that the pipeline's later stages fill."""
    docs = spark.createDataFrame([(i, "word " * i) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    plan = quality.keep(docs, quality.train(docs, labels))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
