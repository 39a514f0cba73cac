"""Personal data by bootstrapped contextual extraction.

Fixed base rules find e-mail addresses, IP addresses, card and phone numbers
in every whole text; they are the seeds.  Looser shapes of each kind propose
further candidates.  The two words before a seed or candidate form a lexical
pattern of its kind.  Spark scores the graph of patterns and instances in
rounds: a pattern is as good as the distinct instances in its slot, an
unproven instance as good as its best pattern.  Slots of any other kind count
against a pattern, so words that may precede anything prove nothing.
Instances of confident patterns become seeds of the next round.

Defined results: a null or empty text has no span; repeated rows have repeated
results and a value counts once however often it is copied; very long texts
are searched whole in linear time; a text's first words have the pattern of
the words there are.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm.common import broadcast_if_small, materialize, ship_code

#: In the order that breaks ties between spans of one start.
KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: A pattern is confident with so many distinct proven values and this score.
MIN_VALUES = 8
MIN_SCORE = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]++(?:[\x20().-]{1,2}[0-9]++)++(?![0-9A-Za-z])")
_LOOSE_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9]++(?:[\x20-][0-9]++)*+(?![0-9A-Za-z])")
_LOOSE_IP = re.compile(r"(?<![0-9A-Za-z.])[0-9]++(?:\.[0-9]++){2,5}+(?![0-9A-Za-z])")
_LOOSE_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20dot\x20|\(dot\)|\[dot\])[A-Za-z0-9-]++)++")
_AT = ("@", "(at)", "[at]", " at ")  # one of them is in every loose e-mail
_WORD = re.compile(r"[^\W\d_]+")

_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
    T.StructField("seed", T.BooleanType()), T.StructField("value", T.StringType()), T.StructField("pattern", T.StringType()),
]))
_ARROW = pa.list_(pa.struct([
    ("kind", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
    ("seed", pa.bool_()), ("value", pa.string()), ("pattern", pa.string()),
]))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the e-mail rule, found from each ``@`` in linear time.

    A match starts where the run of local characters before an ``@`` starts,
    but not inside the match before it.
    """
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if any(c in text for c in "0123456789"):
        out += [(1, *m.span()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], s[0]))


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the looser shapes that meet no base span."""
    found = []
    if any(at in text for at in _AT):
        found += [(0, *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    if any(c in text for c in "0123456789"):
        found += [(1, *m.span()) for m in _LOOSE_IP.finditer(text)]
        found += [(2, *m.span()) for m in _LOOSE_CARD.finditer(text) if 12 <= len(_digits(m[0])) <= 19]
        found += [(3, *m.span()) for m in _LOOSE_PHONE.finditer(text) if 7 <= len(_digits(m[0])) <= 15]
    out, k = [], 0
    for s in sorted(found, key=lambda s: (s[1], s[0])):
        while k < len(base) and base[k][2] <= s[1] and (k + 1 < len(base)):
            k += 1
        if not any(b[1] < s[2] and s[1] < b[2] for b in base[max(0, k - 4) : k + 4]):
            out.append(s)
    return out


def patterns_before(text: str, starts: list[int]) -> list[str]:
    """The last two words before each of the ascending ``starts``, lower-cased; one pass over the text's words."""
    out = []
    found = _WORD.finditer(text)
    word, one, two = next(found, None), "", ""
    for start in starts:
        while word and word.end() <= start:
            one, two = two, word[0]
            word = next(found, None)
        # A word that the start cuts counts up to there.
        pair = (two, text[word.start() : start]) if word and word.start() < start else (one, two)
        out.append(" ".join(w for w in pair if w).lower())
    return out


def instances(text: str | None) -> list[dict]:
    if not text or not (any(at in text for at in _AT) or any(c in text for c in "0123456789")):
        return []
    base = base_spans(text)
    rows = sorted([(a, k, b, True) for k, a, b in base] + [(a, k, b, False) for k, a, b in loose_spans(text, base)])
    return [
        {"kind": k, "first": a, "last": b, "seed": seed, "value": text[a:b], "pattern": pattern}
        for (a, k, b, seed), pattern in zip(rows, patterns_before(text, [r[0] for r in rows]) if rows else [])
    ]


@F.arrow_udf(_SCHEMA)
def _instances(texts: pa.Array) -> pa.Array:
    return pa.array([instances(t) for t in texts.to_pylist()], _ARROW)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, row, found): seeds and candidates of every row; ``row`` is a hash of the text."""
    ship_code(docs.sparkSession)
    out = docs.select("doc_id", F.xxhash64("text").alias("row"), _instances(F.col("text")).alias("found"))
    return materialize(out, "pii-found")


def score_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, pattern, score, proven) after the last round; confident ones only.

    An edge is a distinct (pattern, kind, value).  Its strength is 1 for a
    seed; else that of the best confident pattern of the kind that the value
    was met with in the round before.
    """
    flat = found.select(F.explode("found").alias("f")).select(
        "f.kind", "f.pattern", F.md5(F.col("f.value").cast("binary")).alias("value"), F.col("f.seed").cast("double").alias("seed"))
    edges = materialize(flat.groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    strength = edges.select("kind", "value", F.col("seed").alias("good")).groupBy("kind", "value").agg(F.max("good").alias("good"))
    for _ in range(rounds):
        strong = edges.join(strength, ["kind", "value"])
        # Every distinct value in the pattern's slot, of whatever kind, is in the denominator.
        slots = edges.groupBy("pattern").agg(F.count_distinct("value").alias("slots"))
        per = strong.groupBy("kind", "pattern").agg(
            F.sum("good").alias("good"), F.sum(F.when(F.col("good") >= MIN_SCORE, 1).otherwise(0)).alias("proven"),
            F.count(F.lit(1)).alias("own"))
        # Unproven values of the pattern's own kind are open, not counted against it.
        open_ = F.col("own") - F.col("proven")
        patterns = per.join(slots, "pattern").select(
            "kind", "pattern", "proven", (F.col("good") / F.greatest(F.lit(1), F.col("slots") - open_)).alias("score"))
        patterns = materialize(patterns.where((F.col("proven") >= MIN_VALUES) & (F.col("score") >= MIN_SCORE)
                                              & (F.length("pattern") > 0)), "pii-patterns")
        lifted = edges.join(broadcast_if_small(patterns), ["kind", "pattern"], "left").groupBy("kind", "value").agg(
            F.greatest(F.max("seed"), F.coalesce(F.max("score"), F.lit(0.0))).alias("good"))
        strength = materialize(lifted, "pii-strength")
    return patterns


def extract(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, spans): arrays of (first, kind, last), base rules alone and with what the patterns add."""
    found = find(docs)
    patterns = broadcast_if_small(score_patterns(found, rounds)).select("kind", "pattern")
    more = found.select("doc_id", "row", F.explode("found").alias("f")).where(~F.col("f.seed")).select(
        F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "f.first", "f.kind", "f.last", "f.pattern")
    more = more.join(patterns, ["kind", "pattern"]).groupBy("_d", "_r").agg(
        F.collect_set(F.struct("first", "kind", "last")).alias("_more"))
    more = broadcast_if_small(materialize(more, "pii-more"))
    base = F.transform(F.filter("found", lambda f: f["seed"]), lambda f: F.struct(f["first"].alias("first"), f["kind"].alias("kind"), f["last"].alias("last")))
    out = found.join(more, found["doc_id"].eqNullSafe(F.col("_d")) & (found["row"] == F.col("_r")), "left")
    none = F.array().cast("array<struct<first:int,kind:int,last:int>>")
    return out.select("doc_id", F.sort_array(base).alias("base"),
                      F.sort_array(F.concat(base, F.coalesce("_more", none))).alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["first"].cast("string"), s["last"].cast("string"))), ",")


def digest(extracted: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return extracted.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
