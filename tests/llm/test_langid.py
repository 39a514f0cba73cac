import itertools
import random
import zlib

import numpy as np

from parcelspark.llm import langid
from parcelspark.llm.queries import op2_langid

SF = "/root/testdata/sf0.01"


def test_viterbi_against_every_path():
    rng = random.Random(1)
    nrng = np.random.default_rng(1)
    for _ in range(100):
        scores = (nrng.standard_normal((9, 3)) * 3).astype(np.float32)
        seqs = [np.array([rng.randrange(9) for _ in range(rng.randint(0, 6))], dtype=np.int64) for _ in range(5)]
        for s, p in zip(seqs, langid.viterbi(seqs, scores, 2.0)):
            def value(q):
                return sum(scores[s[i], q[i]] for i in range(len(s))) - 2.0 * sum(a != b for a, b in zip(q, q[1:]))
            assert len(p) == len(s)
            if len(s):
                best = max(value(q) for q in itertools.product(range(3), repeat=len(s)))
                assert abs(value(list(p)) - best) < 1e-3


def test_grams_against_brute_force():
    words = ["ab", "é", "x" * 40, "漢字"]
    bucket, row = langid.gram_buckets(words)
    for k, w in enumerate(words):
        framed = f"\x02{w[:langid.MAX_WORD]}\x03"
        alone, _ = langid.gram_buckets([w])
        assert sorted(bucket[row == k]) == sorted(alone)
        assert len(alone) == sum(len(framed) - n + 1 for n in (1, 2, 3))


def test_scripts_narrow_and_mixed_text_gets_spans(spark):
    rows = [(i, "the cat sat on the mat with a hat and the dog " * 3, "en") for i in range(20)]
    rows += [(100 + i, "der Hund und die Katze sind nicht auf dem Tisch gewesen " * 3, "de") for i in range(20)]
    rows += [(200 + i, "собака и кошка сидят на столе вместе с котом " * 3, "ru") for i in range(20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en", "ru"]
    cyr, lat = (langid._SCRIPT_INDEX[n] for n in ("Cyrillic", "Latin"))
    assert model.uses[cyr].tolist() == [False, False, True] and model.uses[lat].tolist() == [True, True, False]
    lab = langid.Labeller(model)
    text = "the dog sat on the mat und die Katze sind nicht auf dem Tisch собака и кошка"
    spans = lab.spans(text)
    assert [s[2] for s in spans] == ["en", "de", "ru"]
    assert text[slice(*spans[2][:2])] == "собака и кошка"
    assert lab.predict(["ѫѯѱ", "漢字", "123 !?", None, "", "mat 漢字 cat the"]) [1:5] == [("de", 1.0)] + [("und", 0.0)] * 3


def test_chunks_are_cut_and_every_letter_is_scored():
    pieces = lambda c: [w for _, w in langid.pieces_of(c)]
    assert pieces("Don't!") == ["dont"] and pieces("123?!") == [] and pieces("one,TWO-three") == ["one", "two", "three"]
    assert langid.pieces_of("(english,中文Ж人々") == [(1, "english"), (9, "中文"), (11, "ж"), (12, "人々")]
    assert pieces("ที่นี่") == ["ทน"]  # combining marks do not part letters
    for run in ("中" * 100, "x" * 100, "İ" * 100):
        assert "".join(pieces(run)) == "".join(c.lower() for c in run)
        assert all(0 < len(w) <= langid.MAX_WORD for w in pieces(run))


def test_texts_without_blanks_get_spans(spark):
    rng = random.Random(3)
    zh, ja = [["".join(rng.choice(s) for _ in range(400)) for _ in range(20)] for s in ("的一是不了人我在有他", "日本語学校生先年時間")]
    rows = [(i, t, "zh") for i, t in enumerate(zh)] + [(100 + i, t, "ja") for i, t in enumerate(ja)]
    rows += [(200 + i, "the cat sat on the mat with a hat and the dog " * 3, "en") for i in range(20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    lab = langid.Labeller(model)
    text = zh[0][:30] + ja[0][:120]
    spans = lab.spans(text)
    assert [s[2] for s in spans] == ["zh", "ja"] and abs(spans[0][1] - 30) <= langid.MAX_WORD
    assert spans[0][0] == 0 and spans[0][1] == spans[1][0] and spans[1][1] == 150
    assert lab.predict([text])[0][0] == "ja"
    mixed = "the dog sat on the mat," + zh[1][:20]
    assert [(mixed[a:b], lang) for a, b, lang in lab.spans(mixed)] == [("the dog sat on the mat,", "en"), (zh[1][:20], "zh")]


def test_held_out_accuracy_and_folds(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op2_langid(spark, SF).collect()
    assert len(rows) == len(docs)
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.held_out and any(c.isalpha() for c in docs[r.doc_id].text):
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert sum(right) / len(right) > 0.97


def test_odd_rows(spark):
    train = spark.createDataFrame([(1, "a b", None), (None, "hallo welt und", "de"), (2, None, "en"), (2, "the end", "en")],
                                  "doc_id long, text string, lang string")
    model = langid.train(train)
    df = spark.createDataFrame([(1, None), (1, ""), (None, "und " * 50_000), (5, "the the"), (5, "the the")],
                               "doc_id long, text string").selectExpr("*", "'x' as r", "'y' as lang_pred", "1 as score")
    got = langid.identify(df, model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "de"), (1, "und"), (1, "und"), (5, "en"), (5, "en")]
    assert langid.identify(df.limit(0), model).count() == 0
    none = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
