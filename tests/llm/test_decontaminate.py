import hashlib
import random
import re

from pyspark.sql import functions as F

from parcelspark.llm import decontaminate as dc


def words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(rows, items):
    wins = []
    for i, t in items:
        w = words(t)
        wins += [(i, w[s : s + 13]) for s in range(max(1, len(w) - 12)) if w]
    out = []
    for i, t in rows:
        w, hit, ids = words(t), set(), set()
        for item, g in wins:
            for s in range(len(w) - len(g) + 1):
                if w[s : s + len(g)] == g:
                    hit |= set(range(s, s + len(g)))
                    ids |= {str(item)} - {"None"}
        out.append((i, len(w), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def check(spark, rows, items):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as d", "2 as row", "'x' as term", "3 as pos")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'w' as w", "1 as wid")
    out, name = dc.decontaminate(df, bench)
    assert out.columns[:-1] == df.columns
    got = [(r[0], r[1].n_words, r[1].n_hit, list(r[1].items), r[1].contaminated) for r in out.select("doc_id", name).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(brute(rows, items), key=order)
    assert dc.keep_clean(df, bench).columns == df.columns


def test_random_texts_against_brute_force(spark):
    rng = random.Random(8)
    pool = ["a", "b", "The", "éa", "x9", "rare1", "rare2"]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 13, 14, 30]))) for i in range(12)] + [(3, text(14)), (99, None), (98, "!?")]
    rows = [(i, text(rng.randint(0, 60))) for i in range(60)]
    for i in range(60, 90):
        passage = rng.choice(items)[1] or ""
        rows.append((i, text(rng.randint(0, 30)) + " . " + passage.upper().replace(" ", "-") + ", " + text(rng.randint(0, 30))))
    check(spark, rows, items)


def test_without_broadcasts_and_with_a_common_word(spark, monkeypatch):
    monkeypatch.setattr(dc, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(dc, "SALTS", 3)
    rng = random.Random(10)
    text = lambda n: " ".join("the" if rng.random() < 0.7 else rng.choice("abcd") for _ in range(n))
    items = [(i, text(rng.choice([4, 13, 25]))) for i in range(10)]
    check(spark, [(i, f"{text(20)} {rng.choice(items)[1]} {text(5)}") for i in range(30)], items)


def test_odd_rows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item + " z"), (4, "the " * 30),
            (5, (item + " ") * 300), (6, "w0 w1"), (7, item.replace("w13", "w 13"))]
    check(spark, rows, [(1, item), (2, "the " * 13), (3, "the"), (4, "absentword the"), (None, "w0 w1")])
    empty = spark.createDataFrame([], "item_id long, text string")
    check(spark, rows, [(1, None)])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dc.keep_clean(docs, empty).count() == len(rows)
    assert dc.keep_clean(docs.limit(0), empty).count() == 0


def test_proximity(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(60))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([("a", "b"), ("c", "c")], "left_term string, right_term string")
    got = {tuple(r) for r in dc.proximity_matches(dc.build_index(docs), pairs, 3)
           .select("left_term", "right_term", "d", "left_pos", "right_pos").collect()}
    want = set()
    for i, t in rows:
        w = t.split()
        for x, y in (("a", "b"), ("c", "c")):
            want |= {(x, y, i, p, q) for p, u in enumerate(w) for q, v in enumerate(w)
                     if u == x and v == y and abs(p - q) <= 3 and (x != y or p < q)}
    assert got == want


def test_sql_oracle(spark):
    import duckdb

    from parcelspark.llm.oracle import OP7
    from parcelspark.llm.queries import op7_decontaminate

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = op7_decontaminate(spark, sf)
    assert {tuple(r) for r in got.collect()} == set(con.sql(f"SELECT {', '.join(got.columns)} FROM ({OP7})").fetchall())
    ids = F.sha2(F.lit("").cast("binary"), 256)
    assert got.where((F.col("n_items") == 0) & (F.col("items_sha256") != ids)).isEmpty()
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(ids).first()[0]
