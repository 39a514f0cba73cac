import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from parcelspark.llm import lines
from parcelspark.llm.common import materialize

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    def key(x):
        k = x.strip(BLANKS)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        keep = [x for x in all_lines if i is None or len(holders[key(x)]) < min_docs or i == max(holders[key(x)])]
        out.append((i, len(all_lines), len(all_lines) - len(keep), "\n".join(keep)))
    return out


def run(df, **options):
    out, name = lines.dedup(df, **options)
    return out, [(r[0], r[1].n_lines, r[1].n_dropped, r[1].text or "") for r in out.select("doc_id", name).collect()]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as row", "1 as keeper", "2 as i")
    out, got = run(df, **options)
    assert out.columns[:-1] == df.columns
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def test_random_documents_against_brute_force(spark):
    rng = random.Random(4)
    pool = ["License " + "x" * n + c for n in (31, 32, 33, 60) for c in "aAbBéÉ"] + ["", " ", "short"]
    rows = []
    for i in range(60):
        text = "\n".join(rng.choice(["", " ", "\t\x0b"]) + rng.choice(pool) + rng.choice(["", "\r", " "])
                         for _ in range(rng.randint(0, 12)))
        rows.append((i, text))
    check(spark, rows)
    check(spark, rows, batches=3, fanout=2)


def test_odd_rows(spark):
    hot = "The same very common line of forty characters or more"
    rows = [(i, f"{hot}\nown {i}") for i in range(6)] + [(6, None), (7, ""), (None, hot), (5, f"{hot}\nown 5"),
            (5, hot.upper() + "\n" + hot), (8, "\n".join([hot] * 3000)), (9, "é" * 39), (10, "\n\n")]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert run(empty)[1] == []


def test_repeated_rows_of_a_document_count_once(spark):
    few, enough = "A line of two documents in five or more rows only", "A line of five documents, in seven rows altogether"
    rows = [(1, few)] * 4 + [(2, few)] + [(i, f"{enough}\nown {i}") for i in range(3, 8)] + [(3, f"{enough}\nother")] * 2
    check(spark, rows)
    check(spark, rows, batches=2, fanout=2)
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))[1]
    assert [n for i, _, n, _ in got if i < 3] == [0] * 5 and sum(n for _, _, n, _ in got) == 6


def test_runs_compact_by_level_and_add_up(spark, tmp_path):
    rows = [(i, "\n".join(f"line {j % 7} " + "y" * 40 for j in range(i % 9 + 1))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = materialize(lines.line_hashes(df, 40, 5), "t-lines")
    runs = lines.LineRuns(spark, str(tmp_path / "runs"), fanout=2)
    for b in range(5):
        runs.add(hashes.where(F.col("batch") == b))
        assert all(len(level) < 2 for level in runs.levels)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    whole = hashes.select("doc_id", F.explode("keys").alias("k")).groupBy("k.h1", "k.h2").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
    assert sorted(runs.entries().collect()) == sorted(whole.collect())
    n = hashes.select(F.sum(F.size("keys"))).first()[0]
    assert runs.survivors(hashes).count() + runs.dropped(hashes).count() == n


def test_digest_query(spark):
    from parcelspark.llm.queries import op9_lines

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)}
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op9_lines(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and sum(d for _, d, _ in want.values())
