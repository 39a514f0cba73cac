import test_decontaminate
import test_lines
import test_simhash

import corpus_pipeline as cp
from parcelspark.llm import quality
from parcelspark.llm.common import materialize, table



def test_each_stage_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    judged, name = quality.judge(docs, quality.train(docs, table(spark, sf, "labels")))
    keep = {r.doc_id for r in judged.collect() if r[name].kept}
    steps = []
    for stage, f in cp.STAGES:
        docs = materialize(f(spark, docs, sf), "t-stage")
        steps.append({r.doc_id: r for r in docs.collect()})
        if f is not cp.bpe_encoding:
            assert docs.columns == columns, stage
    q, l, s, d, b = steps
    assert set(q) == keep and all(q[i] == before[i] for i in q) and len(q) < len(before)
    want = {i: t for i, _, _, t in test_lines.brute([(i, r.text) for i, r in q.items()])}
    assert {i: r.text for i, r in l.items()} == want
    assert all(r.n_chars == len(r.text) for i, r in l.items() if r.text != q[i].text)
    comp = test_simhash.brute_components([(i, test_simhash.brute_print(r.text)) for i, r in l.items()])
    assert set(s) == {i for i, c in comp.items() if i == c} and all(s[i] == l[i] for i in s)
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    bad = {i for i, *_, hit in test_decontaminate.brute([(i, r.text) for i, r in s.items()], items) if hit}
    assert set(d) == set(s) - bad and all(d[i] == s[i] for i in d)
    assert set(b) == set(d) and {"n_tokens", "ids_sha256", "decoded_sha256"} < set(docs.columns)


def test_stages_take_empty_and_odd_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    odd = docs.limit(3).unionByName(docs.limit(3)).selectExpr("*", "'x' as row", "1 as d", "2 as line_result")
    odd = odd.unionByName(odd.limit(1).selectExpr("cast(null as long) doc_id", "cast(null as string) text",
                                                  "lang", "source", "n_chars", "row", "d", "line_result"))
    for frame in (docs.limit(0), materialize(odd, "t-odd")):
        for _, f in cp.STAGES[:-1]:
            out = f(spark, frame, sf)
            assert out.columns == frame.columns
            out.collect()
        cp.bpe_encoding(spark, frame, sf).collect()

