import hashlib
import random
import re

from parcelspark.llm import pii
from parcelspark.llm.queries import op4_pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or "", re.ASCII):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_rules_against_plain_regular_expressions():
    rng = random.Random(6)
    pool = list("ab@@..--++0123456789()  ") + ["a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "é", "٣", "256"]
    for _ in range(6000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))
        assert [(a, k, b) for k, a, b in pii.base_spans(t)] == brute(t), repr(t)


def test_long_runs_take_linear_time():
    for t in ("a at " * 60_000, "a(at)b" * 40_000, "a@b" * 70_000, "a.b-" * 60_000 + "@c", "1" * 200_000, "a" * 200_000, "a.@" * 50_000, "1." * 100_000, "+1" * 50_000, "1-" * 100_000):
        pii.instances(t)


def test_candidates_do_not_depend_on_other_text():
    rng = random.Random(7)
    pool = ["joe at host.1 now", "joe at  host.com", "x@y.z", "joe(at)a dot b", "4111 1111", "555-765-4321", "1.2.3.4.5", "at", " at ", "word",
            "é", "l" * 200 + "@" + "h" * 100 + ".com", "tel: +1 (555) 123-4567"]
    for _ in range(2000):
        a, b = (" | ".join(rng.choice(pool) for _ in range(rng.randint(1, 3))) for _ in range(2))
        alone, more = pii.instances(a), pii.instances(f"{a} \n# {b}")
        assert [r for r in more if r["last"] <= len(a)] == alone, (a, b)
    assert [r["value"] for r in pii.instances("mail joe at host.1 now")][:1] == ["joe at host.1"]


def test_patterns_are_the_two_words_before_however_far():
    for gap in (" ", " " * 500, "." * 500, "\n" * 90):
        (r,) = pii.instances(f"Please Call{gap}555-765-4321")
        assert r["pattern"] == "please call"
    long = "w" * 200
    assert [r["pattern"] for r in pii.instances(f"my {long} 555-765-4321 and 555-765-4322")] == [f"my {long}", f"{long} and"]
    assert [r["pattern"] for r in pii.instances("555-765-4321 x 555-765-4322")] == ["", "x"]
    assert pii.patterns_before("ab cd", [0, 1, 4, 5]) == ["", "a", "ab c", "ab cd"]


def test_share_of_planted_data_found_by_kind(spark):
    """Plain and loosely written identifiers behind words that prove themselves: what is caught of each kind."""
    makes = {
        "email": (lambda i: f"u{i}@mail.example.com", lambda i: f"u{i} at mail.example.com"),
        "ip": (lambda i: f"10.0.{i}.7", lambda i: f"10.0.{i}.7.1"),
        "card": (lambda i: "4111 1111 1111 1111" if i % 2 else "5500-0000-0000-0004", lambda i: unproven(4111111111111112 + 10 * i)),
        "phone": (lambda i: f"+1 (555) 123-{4000 + i}", lambda i: f"555-765-{4000 + i}"),
    }
    unproven = lambda n: str(n if not pii.luhn(str(n)) else n + 1)
    words = {"email": "write to", "ip": "server address", "card": "charge card", "phone": "please call"}
    texts, want = [], []
    for kind, (plain, loose) in makes.items():
        for i in range(20):
            for make in (plain, loose):
                texts.append(f"note {words[kind]} {make(i)} ok")
                want.append((kind, make is loose, make(i)))
    got = {r.doc_id: r.spans for r in pii.digest(pii.extract(frame(spark, texts))).collect()}
    caught = {}
    for i, (kind, is_loose, value) in enumerate(want):
        start = texts[i].index(value)
        caught.setdefault((kind, is_loose), []).append(f"{kind}:{start}:{start + len(value)}" in got[i].split(","))
    shares = {k: sum(v) / len(v) for k, v in caught.items()}
    assert all(shares[kind, False] == 1 for kind in makes), shares
    assert shares["email", True] == shares["phone", True] == 1, shares
    # Two distinct card numbers prove nothing, and five parts hold a plain address already.
    assert shares["card", True] == shares["ip", True] == 0, shares


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_confident_patterns_find_unseen_identifiers(spark):
    texts = [f"noise text {i} please call me +1 (555) 123-{4000 + i} today" for i in range(12)]
    texts += ["or please call me 555-765-4321 tonight", "the total was 555-765-4322 units", "page of the 555-111-2222"]
    texts += [f"see of the +1 (555) 321-{4000 + i}" for i in range(12)]
    texts += [f"see of the user{i}@mail.example.com" for i in range(12)]  # mixed slot: proves nothing
    rows = {r.doc_id: r.spans for r in pii.digest(pii.extract(frame(spark, texts))).collect()}
    start = texts[12].index("555")
    assert rows[12] == f"phone:{start}:{start + 12}"
    assert rows[13] == rows[14] == ""


def test_second_round_builds_on_the_first(spark):
    texts = [f"please call me +1 (555) 123-{4000 + i}" for i in range(12)]
    texts += [f"please call me 555-200-{3000 + i}" for i in range(12)]  # found in round 1
    texts += [f"reach us under 555-200-{3000 + i}" for i in range(12)]  # same values: pattern of round 2
    texts += ["reach us under 555-999-8888"]
    one = pii.digest(pii.extract(frame(spark, texts), rounds=1)).where("doc_id = 36").first()
    more = pii.digest(pii.extract(frame(spark, texts), rounds=3)).where("doc_id = 36").first()
    assert one.spans == "" and more.spans == "phone:15:27"


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "a@b.co " * 20_000, 1), (None, "x 1.2.3.4", 1), (None, "x 1.2.3.4", 1), (3, "no", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found int").selectExpr("*", "'r' as row", "'k' as kind")
    got = pii.digest(pii.extract(df)).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_email for r in got) == [0, 0, 0, 0, 0, 20_000]
    assert [r.spans for r in got if r.doc_id is None] == ["ip:2:9"] * 2
    assert pii.digest(pii.extract(df.limit(0))).count() == 0


def test_query_base_columns(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op4_pii(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want, r = brute(d.text), rows[d.doc_id]
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == text  # its contexts are random: no pattern is confident
