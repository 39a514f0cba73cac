"""Language identification with spans for mixed-language text.

A blank-separated chunk is cut to words where the script changes, at marks
that are not apostrophes, and after every ``MAX_WORD`` letters, so texts
without blanks are many words and every letter is scored.  A word's script
(Unicode ranges) narrows the candidate languages to those whose training
letters use it.  A word scores, per candidate, the summed log probability of
its letter 1- to 3-grams; Viterbi over the words, with a fixed penalty for
switching, labels spans.  A text's language is the one whose spans
hold the most letters.

Training counts hashed n-grams per language over at most ``SAMPLE_ROWS`` rows
a language (those with the lowest id hashes); the model has ``BUCKETS`` rows
and at most ``MAX_LANGS`` columns whatever the corpus.

Defined results: null texts and texts without a letter are ``und`` with score
0, as is every text when no language was learned; words in a script that no
language uses take the language around them; ties go to the first language in
alphabetical order; very long texts are labelled whole.
"""

from __future__ import annotations

import bisect
import unicodedata
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm.common import WordCache, ship_code

BUCKETS = 1 << 15
MAX_LANGS = 256
SAMPLE_ROWS = 2_000
#: Log-odds (in nats of word score) that a switch of language must pay.
SWITCH = 4.0
#: A language uses a script when so many of its training letters are in it.
SCRIPT_SHARE = 0.02
MAX_WORD = 24  # letters of a word; a longer run is cut to several words
UNKNOWN = "und"

# First code points of ranges and the script each starts ("" = none).
SCRIPTS = (
    (0x0, "Latin"), (0x2B0, ""), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"), (0x590, "Hebrew"),
    (0x600, "Arabic"), (0x700, ""), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Gurmukhi"),
    (0xA80, "Gujarati"), (0xB00, "Odia"), (0xB80, "Tamil"), (0xC00, "Telugu"), (0xC80, "Kannada"),
    (0xD00, "Malayalam"), (0xD80, "Sinhala"), (0xE00, "Thai"), (0xE80, "Lao"), (0xF00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, ""),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""),
    (0x3040, "Kana"), (0x3100, ""), (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, ""), (0x20000, "Han"),
    (0x30000, ""),
)
_STARTS = [s for s, _ in SCRIPTS]
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS if n})
_SCRIPT_INDEX = {n: i for i, n in enumerate(SCRIPT_NAMES)}


def script_of(char: str) -> int:
    """Index into ``SCRIPT_NAMES``, -1 for none."""
    return _SCRIPT_INDEX.get(SCRIPTS[bisect.bisect_right(_STARTS, ord(char)) - 1][1], -1)


def word_script(word: str) -> int:
    """Script of the word's first letter that has one, -1 for none."""
    return next((s for s in map(script_of, word) if s >= 0), -1)


def pieces_of(chunk: str) -> list[tuple[int, str]]:
    """(start, lower-cased letters) of the chunk's words, in order.

    Letters without a script of their own go with those before them, or else
    with those after.  Apostrophes, combining marks and invisible characters
    do not part letters.
    """
    if len(chunk) <= MAX_WORD and chunk.isascii() and chunk.isalpha():
        return [(0, chunk.lower())]
    out, start, word, script = [], 0, "", -1
    for i, c in enumerate(chunk):
        if c.isalpha():
            low, own = c.lower(), script_of(c)
            if word and (len(word) + len(low) > MAX_WORD or (own >= 0 and script >= 0 and own != script)):
                out.append((start, word))
                word, script = "", -1
            if not word:
                start = i
            word += low
            script = own if script < 0 else script
        elif word and c not in "'\u2019" and unicodedata.category(c) not in ("Mn", "Mc", "Me", "Cf"):
            out.append((start, word))
            word, script = "", -1
    if word:
        out.append((start, word))
    return out


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word row) of every 1- to 3-gram of the words, each framed by a mark."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    framed = [f"\x02{w[:MAX_WORD]}\x03" for w in words]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    code = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(words)), sizes)
    out, rows, key = [], [], np.zeros(len(code), np.uint64)
    for n in (1, 2, 3):
        m = len(code) - n + 1
        key = (key[:m] if n > 1 else np.zeros(m, np.uint64)) * np.uint64(1_000_003) + code[n - 1 :] + np.uint64(n)
        inside = row[:m] == row[n - 1 :]
        mixed = (key[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
        out.append(mixed.astype(np.int64))
        rows.append(row[:m][inside])
    return np.concatenate(out), np.concatenate(rows)


@dataclass
class Model:
    langs: list[str]
    log_prob: np.ndarray  # BUCKETS x langs, float32
    uses: np.ndarray  # scripts x langs, bool

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Words x languages: log probabilities; languages of other scripts far below, all zero without any."""
        scores = np.zeros((len(words), len(self.langs)), np.float32)
        for i in range(0, len(words), 20_000):
            part = words[i : i + 20_000]
            bucket, row = gram_buckets(part)
            for lang in range(len(self.langs)):
                scores[i : i + len(part), lang] = np.bincount(row, self.log_prob[bucket, lang], len(part)) / 3
        script = np.fromiter(map(word_script, words), np.int64, len(words))
        allowed = self.uses[script] & (script >= 0)[:, None]
        some = allowed.any(1)
        scores[~some] = 0
        return np.where(allowed | ~some[:, None], scores, scores.min(1, keepdims=True) - 50) if len(self.langs) else scores


def viterbi(sequences: list[np.ndarray], scores: np.ndarray, switch: float) -> list[np.ndarray]:
    """Best label path of each sequence of score rows; all sequences advance together."""
    n, langs = len(sequences), scores.shape[1]
    order = sorted(range(n), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    longest = int(lengths[0]) if n else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left").tolist()  # sequences longer than t
    flat = np.concatenate([sequences[i] for i in order]) if n else np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1])) if n else np.zeros(0, np.int64)
    best = np.zeros((n, langs), np.float32)
    stay = np.zeros((len(flat), langs), bool)  # keep the language, else come from the leader
    leader = np.zeros(len(flat), np.int16)
    for t in range(longest):
        a = active[t]
        at = first[:a] + t
        v = best[:a]
        if t:
            lead = v.argmax(1)
            top = v[np.arange(a), lead][:, None]
            keep = v >= top - switch
            stay[at] = keep
            leader[at] = lead
            v = np.where(keep, v, top - switch) - top
        best[:a] = v + scores[flat[at]]
    path = np.zeros(len(flat), np.int16)
    state = best.argmax(1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = first[:a] + t
        s = state[:a]
        path[at] = s
        if t:
            state[:a] = np.where(stay[at, s], s, leader[at])
    out: list = [None] * n
    for k, i in enumerate(order):
        out[i] = path[first[k] : first[k] + lengths[k]]
    return out


class Labeller:
    """Scores new chunks' words once per worker while they are remembered."""

    LIMIT = 250_000

    def __init__(self, model: Model, switch: float = SWITCH):
        self.model, self.switch = model, switch
        self.reset()

    def reset(self) -> None:
        self.row: dict[str, int] = {}  # chunk -> its row of ``first`` and ``size``
        self.first = np.zeros(0, np.int64)  # the chunk's first word ...
        self.size = np.zeros(0, np.int64)  # ... and how many it has; 0: no letter, no label
        self.scores = np.zeros((0, len(self.model.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        pieces = [pieces_of(c) for c in chunks]
        words = [w for p in pieces for _, w in p]
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        base = len(self.row)
        self.row.update((c, base + i) for i, c in enumerate(chunks))
        self.first = np.concatenate([self.first, len(self.letters) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        if words:
            self.scores = np.concatenate([self.scores, self.model.word_scores(words)])
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, words), np.int64, len(words))])

    def _words(self, chunks: list[str]) -> np.ndarray:
        """Rows of ``scores`` of the chunks' words in turn."""
        at = np.fromiter(map(self.row.__getitem__, chunks), np.int64, len(chunks))
        first, size = self.first[at], self.size[at]
        if not len(at) or size.max() <= 1:
            return first[size > 0]
        return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def label(self, texts: list[str | None]) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
        """Per text: its chunks; the labels and letter counts of their words."""
        if max(len(self.row), len(self.letters)) > self.LIMIT:
            self.reset()
        split = [(t or "").split() for t in texts]
        new = list({c for s in split for c in s if c not in self.row})
        if new:
            self._learn(new)
        codes = [self._words(s) for s in split]
        paths = viterbi(codes, self.scores, self.switch)
        return [(s, p, self.letters[c]) for s, p, c in zip(split, paths, codes)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.model.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = []
        for _, path, letters in self.label(texts):
            if not len(path):
                out.append((UNKNOWN, 0.0))
                continue
            share = np.bincount(path, letters, len(self.model.langs))
            k = int(share.argmax())
            out.append((self.model.langs[k], float(share[k] / share.sum())))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) of each run of words with one label, in code points."""
        (chunks, path, _), = self.label([text])
        out: list[list] = []
        at = k = 0
        for c in chunks:
            at = text.index(c, at)
            # A chunk's words share it out: marks go with the word before them, leading ones with the first.
            cuts = [0, *(i for i, _ in pieces_of(c)[1:]), len(c)]
            for a, b in zip(cuts, cuts[1:]) if self.size[self.row[c]] else ():
                lang = self.model.langs[path[k]]
                k += 1
                if out and out[-1][2] == lang:
                    out[-1][1] = at + b
                else:
                    out.append([at + a, at + b, lang])
            at += len(c)
        return [tuple(s) for s in out]


_HELD: dict[str, Labeller] = {}


def labeller_for(name: str, model: Model, switch: float) -> Labeller:
    """The worker's labeller of this name, kept from task to task."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Labeller(model, switch)
    return _HELD[name]


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, max_langs: int = MAX_LANGS) -> Model:
    """Model of (text, lang) rows; ``doc_id`` only picks the bounded sample."""
    ship_code(docs.sparkSession)
    usable = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = dict(usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs + 1).collect())
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(sizes)
    log_prob = np.zeros((BUCKETS, len(langs)), np.float32)
    uses = np.zeros((len(SCRIPT_NAMES), len(langs)), bool)
    if not langs:
        return Model(langs, log_prob, uses)
    # A hash threshold per language: about sample_rows rows of each, found without a sort.
    rate = F.lit(0.0)
    for lang in langs:
        rate = F.when(F.col("lang") == lang, F.lit(sample_rows / sizes[lang])).otherwise(rate)
    spot = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)
    index = {lang: i for i, lang in enumerate(langs)}

    def count(batches):
        grams = np.zeros((len(langs), BUCKETS), np.int64)
        scripts = np.zeros((len(langs), len(SCRIPT_NAMES)), np.int64)
        cut = WordCache(pieces_of, 20_000)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w for c in text.split() for _, w in cut[c]]
                if words:
                    bucket, _ = gram_buckets(words)
                    grams[index[lang]] += np.bincount(bucket, minlength=BUCKETS)
                    for w in words:
                        s = word_script(w)
                        if s >= 0:
                            scripts[index[lang], s] += len(w)
        both = np.concatenate([grams, scripts], axis=1)
        row, cell = np.nonzero(both)
        if len(row):
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(cell), pa.array(both[row, cell])], ["row", "cell", "n"])

    counted = (
        usable.where(spot < rate).select("text", "lang").mapInArrow(count, "row long, cell long, n long")
        .groupBy("row", "cell").agg(F.sum("n").alias("n")).toPandas()
    )
    full = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    full[counted["row"].to_numpy(int), counted["cell"].to_numpy(int)] = counted["n"].to_numpy(float)
    grams, scripts = full[:, :BUCKETS], full[:, BUCKETS:]
    smooth = (grams + 0.1) / (grams.sum(1, keepdims=True) + 0.1 * BUCKETS)
    log_prob = np.log(smooth).T
    log_prob -= log_prob.max(1, keepdims=True)
    uses = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)) & (scripts > 0)
    return Model(langs, np.maximum(log_prob, -12).astype(np.float32), uses.T)


def predictor(model: Model, switch: float = SWITCH):
    """Column function: text -> struct(lang_pred, score)."""
    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    arrow = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
    name = uuid.uuid4().hex

    @F.arrow_udf(schema)
    def language(texts: pa.Array) -> pa.Array:
        labeller, rows = labeller_for(name, model, switch), []
        for i in range(0, len(texts), 1_000):
            rows += labeller.predict(texts.slice(i, 1_000).to_pylist())
        return pa.array([{"lang_pred": a, "score": b} for a, b in rows], arrow)

    return language


def identify(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every row."""
    ship_code(docs.sparkSession)
    found: Column = predictor(model)(F.col(text)).alias("r")
    return docs.select(key, found).select(key, "r.lang_pred", "r.score")
