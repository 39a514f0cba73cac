"""Quality rules: document statistics, fixed base rules and boosted trees.

The statistics of every whole text are computed in the workers.  Trees are
fitted on a bounded, documented sample of labelled rows (``SAMPLE_ROWS``, the
rows whose id has a low hash) and score all rows as flat node arrays.
The score may never rise with the share of repeated words, duplicate lines or
symbols.

Defined results: a null or empty text has zero statistics and fails the base
rules; very long texts are measured whole; repeated rows give repeated
results; repeated labels of one id count once (the highest); without labels
the trees are empty and the base rules alone decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm import gbt
from parcelspark.llm.common import BLANKS, LOWER, UPPER, fresh, hash_sample, ship_code

#: About so many labelled rows fit the trees (16 numbers a row reach the driver).
SAMPLE_ROWS = 20_000
#: Rows go when the trees put the chance of label 1 below this.
KEEP_AT = 0.25
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "mark_share", "bang_share", "wide_share", "line_words", "log_chars",
    "letter_share",
)
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in BASE] + [T.StructField("features", T.ArrayType(T.DoubleType()))]
)
_SCORED = T.StructType([*_SCHEMA.fields[:-1], T.StructField("score", T.DoubleType())])
_ARROW = pa.struct([(c, pa.int64()) for c in BASE] + [("features", pa.list_(pa.float64()))])
_MARKS = b"!\"'(),-./:;?[]_`{}~@\\^+="


def repeated_words(words: list) -> tuple[int, int]:
    """(words in 3-word windows that occur twice or more, distinct words)."""
    codes: dict = {}
    c = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    if len(c) < 4:
        return 0, len(codes)
    k = len(codes)
    pairs = c[:-1] * k + c[1:]
    if k >= 1 << 20:  # three codes would not fit 63 bits
        _, pairs = np.unique(pairs, return_inverse=True)
    grams = pairs[:-1] * k + c[2:]
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0, k
    again = np.zeros(len(s), bool)
    again[1:] |= same
    again[:-1] |= same
    at = order[again]
    hit = np.zeros(len(c), bool)
    hit[at] = hit[at + 1] = hit[at + 2] = True
    return int(hit.sum()), k


def measure(text: str | None) -> tuple:
    """The base counts and the features of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text)
    blanks = len(raw) - len(raw.translate(None, BLANKS.encode()))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    seen: set = set()
    dups = lines = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    repeats, distinct = repeated_words(words)
    left_out = lambda kind: len(raw) - len(raw.translate(None, kind))
    size, letters = max(chars, 1), chars - blanks
    wide = 0 if text.isascii() else chars - len(raw.translate(None, bytes(range(128, 256))))
    plain = left_out(LOWER.encode() + UPPER.encode())
    features = (
        float(np.log1p(n)), letters / max(n, 1), symbols / size, dups / max(lines, 1), repeats / max(n, 1),
        distinct / max(n, 1), left_out(UPPER.encode()) / size, left_out(b"0123456789") / size,
        left_out(_MARKS) / size, raw.count(b"!") / size, wide / size, n / max(lines, 1), float(np.log1p(chars)),
        (plain + wide) / size,
    )
    return n, letters, symbols, dups, repeats, list(features)


def _measured(texts: pa.Array) -> list[tuple]:
    slices = (texts.slice(i, 500).to_pylist() for i in range(0, len(texts), 500))
    return [measure(t) for part in slices for t in part]


@F.arrow_udf(_SCHEMA)
def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array([dict(zip((*BASE, "features"), r)) for r in _measured(texts)], _ARROW)


def statistics(text: Column) -> Column:
    """Struct of the base counts and ``features`` of a text column."""
    return _statistics(text)


def base_failed(stats: Column) -> Column:
    n = stats["n_words"]
    return (n < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> gbt.FlatTrees:
    """Trees for ``labels.quality``, fitted on about ``sample_rows`` labelled rows (all if there are fewer)."""
    ship_code(docs.sparkSession)
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    # Broadcast: about sample_rows ids.
    chosen = F.broadcast(hash_sample(known, sample_rows, known.count()))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").select(
        "doc_id", "label", F.xxhash64("text").alias("tie"), statistics(F.col("text")).getField("features").alias("x"))
    # Of rows that share an id, the one with the lowest text hash; only numbers reach the driver.
    rows = rows.groupBy("doc_id").agg(F.min_by("x", "tie").alias("x"), F.first("label").alias("label")).toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    falling = np.array([-1 if f in FALLING else 0 for f in FEATURES])
    return gbt.fit(x, rows["label"].to_numpy(float), falling)


def scored_statistics(text: Column, model: gbt.FlatTrees) -> Column:
    """Struct of the base counts of a text column and ``score``, the chance of label 1.

    One function: with a second one for the score a task would hold two Python workers.
    """

    @F.arrow_udf(_SCORED)
    def quality_score(texts: pa.Array) -> pa.Array:
        rows = _measured(texts)
        x = np.array([r[-1] for r in rows], float).reshape(len(rows), len(FEATURES))
        score = model.probability(x) if len(x) else np.zeros(0)
        base = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(BASE))]
        return pa.StructArray.from_arrays([*base, pa.array(score, pa.float64())], [*BASE, "score"])

    return quality_score(text)


def judge(docs: DataFrame, model: gbt.FlatTrees) -> tuple[DataFrame, str]:
    """``docs`` with one more struct column (base counts, base_failed, score, kept); its name."""
    ship_code(docs.sparkSession)
    name = fresh(docs, "quality_result")
    scored = docs.withColumn(name, scored_statistics(F.col("text"), model))
    s = F.col(name)
    failed = base_failed(s)
    return scored.withColumn(name, F.struct(
        *[s[c].alias(c) for c in BASE], failed.alias("base_failed"), s["score"].alias("score"),
        (~failed & (s["score"] >= KEEP_AT)).alias("kept"),
    )), name


def keep(docs: DataFrame, model: gbt.FlatTrees) -> DataFrame:
    """The rows of ``docs`` that the rules and the trees keep, columns unchanged."""
    judged, name = judge(docs, model)
    return judged.where(F.col(name)["kept"]).select(*docs.columns)
