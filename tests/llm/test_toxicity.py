import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from parcelspark.llm import toxicity as tx
from parcelspark.llm.queries import op5_toxicity

SF = "/root/testdata/sf0.1"


def brute_kernel(s, t):
    """Weighted common subsequences of bounded steps, over the norms."""
    def features(x):
        out = []
        def walk(order, at, path, left):
            if not left:
                out.append(("".join(x[i] for i in path), tx.DECAY ** (path[-1] - path[0] + 1)))
                return
            for step in range(1, tx.STEPS[order] + 1):
                if at + step < len(x):
                    walk(order, at + step, [*path, at + step], left - 1)
        for order in tx.STEPS:
            for i in range(len(x)):
                walk(order, i, [i], order - 1)
        return out
    a, b = features(s), features(t)
    norm = lambda f: np.sqrt(sum(w * w for _, w in f)) or 1
    return sum(v * w for u, v in a for z, w in b if u == z) / norm(a) / norm(b)


def test_kernel_against_brute_force():
    words = ["idiot", "id-iot", "idixot", "banana", "ab", "", "éàéàé", "a" * 9, "stupid", "tupids"]
    k = tx.kernel(words, tx.landmark_table(words))
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert abs(k[i, j] - brute_kernel(s, t)) < 1e-4, (s, t)
    assert k[0, 2] > 3 * k[0, 3]


def test_svm_and_folding():
    bad, good = ["idiot", "stupid", "loser"], ["the", "thing", "other", "stone", "idea", "rose", "lost", "study"]
    model = tx.fit(bad, good, np.ones(len(good)), [])
    assert (model.margins(bad) > 0).all() and (model.margins(good) < 0).all()
    assert model.margins(["idixot"])[0] > model.margins(["idea"])[0]


def test_units():
    u = tx.cut(pa.array(["so i d i o t !", None, "A (b).\nc d! e\x85f", " ", "A ..."], pa.string()))
    assert [u.names[i] for i in u.unit] == ["so", "i", "d", "i", "o", "t", "", "a", "b", "c", "d", "e", "f", "a", ""]
    assert u.text.tolist() == [0] * 7 + [2] * 6 + [4] * 2
    assert np.flatnonzero(np.diff(u.sentence)).tolist() == [6, 8, 10, 12]
    assert [x.tolist() if isinstance(x, np.ndarray) else x for x in tx.spaced_runs(u)] == [["idiot"], [0]]
    assert tx.core("(Don't!)") == "don't"
    assert tx.variants("i-d.iot!") == ["\x02i-d.iot", "\x02idiot"]
    long = "x" * 50 + "idiot" + "x" * 50
    assert any("idiot" in p for p in tx.pieces(long)) and max(map(len, tx.pieces(long))) <= tx.MAX_UNIT


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return tx.train(docs.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 0"))


def test_held_out_accuracy(spark):
    """Over all held-out labels; texts of quality 0 are scrambled, and their label 1 often has nothing left to show for it."""
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic is not null").collect()}
    rows = op5_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(*labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    share = lambda quality, toxic: [p for q, t, p in held if q in quality and t == toxic]
    figures = {k: (sum(v), len(v)) for k, v in (
        ("caught", share((0, 1, None), 1)), ("flagged", share((0, 1, None), 0)),
        ("caught, quality 1", share((1,), 1)), ("flagged, quality 1", share((1,), 0)), ("caught, quality 0", share((0,), 1)))}
    print(figures)
    least = {"caught": 0.88, "caught, quality 1": 0.95, "caught, quality 0": 0.4}
    most = {"flagged": 0.01, "flagged, quality 1": 0.01}
    assert all(figures[k][0] >= x * figures[k][1] for k, x in least.items()), figures
    assert all(figures[k][0] <= x * figures[k][1] for k, x in most.items()), figures
    for r in rows[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (1 if r.score >= 0.7 else 0)


def test_disguised_insults_and_odd_rows(spark, model):
    texts = ["what an idiot you are", "what an i-d-i-o-t you are", "what an i d i o t you are", "what a clowwn", "disgussting",
             "the thing and the other", "", None, "of " * 100_000, "?! ..."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "*", "'u' as unit", "1 as margin", "2 as label")
    got = {r.doc_id: r.score for r in tx.score_documents(df, model).collect()}
    assert all(got[i] >= tx.FLAG_AT for i in range(5)) and all(got[i] < tx.FLAG_AT for i in range(5, 10)), got
    assert tx.score_documents(df.limit(0), model).count() == 0
    parts = tx.Scorer(model).sentences("The thing is on. What an idiot.\nAnd the other")
    assert [s >= tx.FLAG_AT for _, s in parts] == [False, True, False]


def test_windows_against_joined_strings(monkeypatch):
    monkeypatch.setattr(tx, "LETTERS", 7)  # parts of a few units
    model = tx.fit(["idiot", "stupid", "loser"], ["the", "thing", "other", "stone", "idea", "study"], np.ones(6), [])
    units = ["a", "b", "id", "iot", "stu", "pid", "é" * 40, "x", "of", "the"]
    for many, got in [*zip((2, 3), model.window_margins(*tx.codes_of(units))), *zip((2, 3), model._windows_in(*tx.codes_of(units)))]:
        want = model.margins([tx.START + "".join(units[i : i + many]) for i in range(len(units) - many + 1)])
        assert len(got) == len(want) and np.abs(got - want).max() < 1e-4
    assert list(tx.windows_of("So - Ha. No\nwe go on")) == [["so", "ha"], ["we", "go"], ["go", "on"], ["we", "go", "on"]]


def test_plain_units_come_from_the_pass_over_letters():
    model = tx.fit(["idiot", "stupid", "loser"], ["the", "thing", "other", "stone", "idea", "study"], np.ones(6), [])
    odd = ["i-d.iot!", "(Don't!)", "É", "ÉÀé", "İx", "ΣΑΣ", "a" * 31, "a" * 32, "x" * 70 + "idiot", "...", "ß", "٣", "\x00", "日本語です", "ﬁx", "ǅ"]
    texts = [*odd, " ".join(odd), "what an idiot . the stu pid thing", "a b c d\x00 \x00 \x00", "", None]
    found, worst = tx.Scorer(model).evidence(texts)
    for text, (most, *_), unit in zip(odd, found, worst):
        low = tx.cut(pa.array([text])).names[0]
        assert abs(most - model.margins(tx.variants(low)).max()) < 1e-9, text
        assert unit == tx.variants(low)[0]
    assert worst[-1] is None and found[-1, 0] == model.bias
    # Units that are their only form are not taken apart one by one.
    plain = " ".join("".join(random.Random(i).choices("abdeiklmnorstué", k=i % 31 + 1)) for i in range(500))
    scorer = tx.Scorer(model)
    scorer.evidence([plain, "Two words, (and) i-d.iot!"])
    assert list(scorer.known) == ["i-d.iot"]


def test_window_ids_in_bulk():
    texts = ["So - Ha. No\nwe go on the long way", "a b", "a", "", None, "x the y z w the", "a b a b a b", "é ü-ß. Ñ o p"]
    for text in texts:
        for bad in (set(), {"the"}, {"the", "b"}):
            want = sorted({tx.window_id(w) for w in tx.windows_of(text) if bad.isdisjoint(w)})
            assert tx.window_ids(text, bad).tolist() == want
            assert tx._distinct_windows(sorted(bad)).func(pa.array([text], pa.string())).to_pylist() == [want]
        some = [tx.window_id(w) for w in tx.windows_of(text)][::2]
        want = sorted({" ".join(w) for w in tx.windows_of(text) if tx.window_id(w) in some})
        assert tx._spelled(some).func(pa.array([text], pa.string())).to_pylist() == [want]


def test_insults_parted_by_a_blank(model):
    score = tx.Scorer(model).scores(["what an id iot you are", "what an i d iot you are", "how stu pid it is", "the thing and the other"])
    assert (score[:3] >= tx.FLAG_AT).all() and score[3] < tx.FLAG_AT, score


def test_insults_of_several_common_words(spark):
    rng = random.Random(5)
    filler = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows = []
    for i in range(1200):
        parts = [["waste"], ["of"], ["space"]] if i % 4 else [["waste", "of", "space"]]
        parts += [[rng.choice(filler)] for _ in range(12)]
        rng.shuffle(parts)
        rows.append((i, " ".join(w for p in parts for w in p), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tx.train(df, df)
    assert model is not None
    a, b, c, d = filler[:4]
    score = tx.Scorer(model).scores([f"{a} {b} waste of space {c} {d}", f"{a} space {b} of {c} waste {d}", f"{a} {b} {c} {d}"])
    assert score[0] > 0.5 > max(score[1:]), score


def test_without_labels_every_score_is_zero(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert tx.train(docs, labels) is None and tx.train(docs.limit(0), labels.limit(0)) is None
    assert [r.score for r in tx.score_documents(docs, None).collect()] == [0.0] * 3
