"""Toxicity by a subsequence string-kernel support vector machine.

Two strings are as similar as the letter subsequences of length 3 and 4 they
share, each counted with ``DECAY`` to the power of the span it covers (steps
between its letters of at most ``STEPS``), over the product of the strings'
norms.  Gaps cost little, so ``i-d.i x`` still resembles what it hides.

A text is cut to sentences, a sentence to units: words, and runs of single
characters set apart by blanks, joined.  Labels mark texts, so training is
multi-instance: the units that labelled texts of one kind share far beyond
chance are the witnesses of a toxic sentence, units of clean sentences the
other class.  Two or three neighbouring units of a sentence, joined, are
instances too (*windows*): as witnesses and as clean examples in training, and
in scoring where no unit in them has a positive margin, so insults parted by a blank or made of several words count.  A linear support vector machine is fitted on Nyström features
(kernel values with landmark units, times the inverse root of the landmarks'
own kernel).  Its weights fold into one number per subsequence, so a unit is
scored by table look-ups.  A logistic curve turns a text's evidence, over the
units and windows of all its sentences, into the score: the largest margin, the sum of the
positive margins, and that sum per hundred units.

Fitting uses about ``TOXIC_ROWS`` + ``CLEAN_ROWS`` labelled rows, those with
low id hashes (near copies once; all if there are fewer), and at most ``UNITS`` chosen units of
either class; ``REFITS`` times the worst unit of every sampled text joins them.
Landmarks are spread over ``POOL`` of the chosen units.  Subsequences are
counted in ``BUCKETS`` hash buckets, so a few share one; the kernel is that of
the buckets.

Defined results: null or empty texts score like a text without a unit; without
both labels every score is 0; repeated labels of an id count once (the
highest); very long texts are scored whole.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm import words
from parcelspark.llm.common import hash_sample, materialize, ship_code

TOXIC_ROWS = 3_000
CLEAN_ROWS = 9_000
UNITS = 8_000
LANDMARKS = 192
REFITS = 2
DECAY = 0.6
STEPS = {3: 3, 4: 2}
BUCKETS = 1 << 18
#: Units that landmarks are chosen from, drawn at random.
POOL = 2_000
START = "\x02"
MAX_UNIT = 32  # a longer unit is scored in overlapping pieces of this length
FLAG_AT = 0.7

#: Stands for a line's end among the units; a real one of this private character ends a sentence too.
_LINE = "\ue000"
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: Letters that a pass over windows works on at a time.
LETTERS = 1 << 15
MOST_REACH = max((n - 1) * most for n, most in STEPS.items())
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")


@dataclass
class Units:
    """The units of some texts in order."""

    distinct: pa.Array  # distinct units, lower-cased, without marks at the ends
    unit: np.ndarray  # number of each unit's name
    text: np.ndarray
    sentence: np.ndarray
    single: np.ndarray  # whether it is one character

    @functools.cached_property
    def names(self) -> list[str]:
        return self.distinct.to_pylist()


def cut(texts: pa.Array) -> Units:
    """Units are set apart by white space; a sentence ends with a line or behind ``.``, ``!`` or ``?`` before white space."""
    lines = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", f" {_LINE} ")
    lists = pc.utf8_split_whitespace(lines)
    flat, bounds = lists.flatten(), lists.offsets.to_numpy()
    coded = flat.dictionary_encode()
    raw = coded.dictionary
    lower = pc.utf8_trim(pc.utf8_lower(raw), _MARKS).dictionary_encode()
    at = coded.indices.to_numpy().astype(np.intp)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    of_raw = lambda flags: flags.to_numpy(zero_copy_only=False).astype(bool)[at]
    line = of_raw(pc.equal(raw, _LINE))
    closes = line | of_raw(pc.match_substring_regex(raw, "[.!?]$"))
    real = of_raw(pc.not_equal(raw, "")) & ~line
    sentence = np.cumsum(closes) - closes + text  # a new text is a new sentence too
    single = of_raw(pc.equal(pc.utf8_length(raw), 1))
    unit = lower.indices.to_numpy()[at]
    return Units(lower.dictionary, unit[real], text[real], sentence[real], single[real])


def spaced_runs(units: Units) -> tuple[list[str], np.ndarray]:
    """Three and more single characters in a row in a sentence, joined; and the text of each such run."""
    at = np.flatnonzero(units.single)
    if not len(at):
        return [], np.zeros(0, np.int64)
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (units.sentence[at[1:]] != units.sentence[at[:-1]])])
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate([first, [len(at)]]))
    first, size = first[size > 2], size[size > 2]
    held = units.distinct.take(pa.array(units.unit[at[np.repeat(first + size - np.cumsum(size), size) + np.arange(size.sum())]])).to_pylist()
    stops = np.cumsum(size).tolist()
    return ["".join(held[i:j]) for i, j in zip([0, *stops], stops)], units.text[at[first]].astype(np.int64)


def core(unit: str) -> str:
    """Lower-cased, without marks at the ends."""
    low = unit.lower()
    if low.isalnum():
        return low
    a, b = 0, len(low)
    while a < b and not low[a].isalnum():
        a += 1
    while b > a and not low[b - 1].isalnum():
        b -= 1
    return low[a:b]


def pieces(unit: str) -> list[str]:
    half = MAX_UNIT // 2
    return [unit[i : i + MAX_UNIT] for i in range(0, max(1, len(unit) - half), half)] if len(unit) > MAX_UNIT else [unit]


def variants(unit: str) -> list[str]:
    """What a unit is scored as: its core and, with marks inside, the core without them; a mark frames the start."""
    low = core(unit)
    out = pieces(START + low)
    if not low.isalnum():
        out = out + pieces(START + "".join(c for c in low if c.isalnum()))
    return out


def letters_of(unit: str) -> str:
    """What a unit gives to a window: its letters and digits, lower-cased."""
    low = unit.lower()
    return low if low.isalnum() else "".join(c for c in low if c.isalnum())


def sentences_of(text: str | None) -> Iterator[list[str]]:
    """What the units of each sentence of a text give to windows; units of marks alone are passed over."""
    for sentence in _SENTENCE.split(text or ""):
        yield [w for w in map(letters_of, sentence.split()) if w]


def windows_of(text: str | None) -> Iterator[list[str]]:
    """Two and three neighbouring units of each sentence of a text."""
    for units in sentences_of(text):
        for many in (2, 3):
            for i in range(len(units) - many + 1):
                yield units[i : i + many]


_TIMES = np.uint32(0x85EBCA6B)
_MIX = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - 18)
#: Salt of the subsequences of each length.
_SALT = {3: np.uint32(0x3C6EF372), 4: np.uint32(0xDAA66D2B)}


def _bucket(key: np.ndarray, order: int) -> np.ndarray:
    mixed = key ^ _SALT[order]
    mixed *= _MIX
    mixed >>= _SHIFT
    return mixed


def codes_of(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all units as one string, length of each)."""
    code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    return code, np.fromiter(map(len, units), np.int64, len(units))


def _keys(letter_at, first: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """(bucket, reach, length) of the subsequences from ``first`` on, for each choice of steps.

    ``letter_at(reach)`` gives the letters ``reach`` after the first ones; arrays
    may get shorter with the reach.
    """
    one = first * _TIMES
    for a in range(1, max(STEPS.values()) + 1):
        two = letter_at(a)
        two = one[: len(two)] + two
        two *= _TIMES
        for b in range(1, max(STEPS.values()) + 1):
            three = letter_at(a + b)
            three = two[: len(three)] + three
            if max(a, b) <= STEPS[3]:
                yield _bucket(three, 3), a + b, 3
            if max(a, b) <= STEPS[4]:
                three *= _TIMES
                for c in range(1, STEPS[4] + 1):
                    four = letter_at(a + b + c)
                    yield _bucket(three[: len(four)] + four, 4), a + b + c, 4


def _patterns(units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(unit row, bucket, weight) of the subsequences of each choice of steps in turn."""
    code, sizes = codes_of(units)
    row = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
    for bucket, reach, _ in _keys(lambda r: code[r:], code):
        own = row[: len(bucket)]
        inside = own == row[reach:]
        yield own[inside], bucket[inside].astype(np.int64), DECAY ** (reach + 1)


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit row, bucket, weight) of every bounded-step subsequence of every unit."""
    parts = [(row, bucket, np.full(len(row), weight)) for row, bucket, weight in _patterns(units)]
    return tuple(np.concatenate(c) for c in zip(*parts))


def norms(n: int, row: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Norm of each unit over its occurrences of subsequences; 1 for units without any."""
    square = np.bincount(row, weight * weight, n)
    return np.sqrt(np.where(square > 0, square, 1.0))


@dataclass
class Landmarks:
    """Normed weights of the landmarks on the subsequences they hold."""

    index: np.ndarray  # per bucket: row of ``weight``, 0 for none
    weight: np.ndarray  # rows x landmarks, float32; row 0 is zero


def landmark_table(landmarks: list[str]) -> Landmarks:
    row, bucket, weight = subsequences(landmarks)
    held, at = np.unique(bucket, return_inverse=True)
    index = np.zeros(BUCKETS, np.int32)
    index[held] = np.arange(1, len(held) + 1)
    table = np.zeros((len(held) + 1, len(landmarks)), np.float32)
    np.add.at(table, (at + 1, row), weight / norms(len(landmarks), row, weight)[row])
    return Landmarks(index, table)


def kernel(units: list[str], table: Landmarks) -> np.ndarray:
    """Kernel values of units (rows) with the landmarks."""
    out = np.zeros((len(units), table.weight.shape[1]))
    for i in range(0, len(units), 200):
        part = units[i : i + 200]
        row, bucket, weight = subsequences(part)
        weight = weight / norms(len(part), row, weight)[row]
        at = table.index[bucket]
        shared = at > 0
        row, at, weight = row[shared], at[shared], weight[shared].astype(np.float32)
        order = np.argsort(row, kind="stable")
        row, at, weight = row[order], at[order], weight[order]
        if len(row):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            out[i + row[starts]] = np.add.reduceat(table.weight[at] * weight[:, None], starts, axis=0)
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by accelerated gradient steps; y is -1 or 1."""
    w, v, b, c = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0.0, 0.0
    weight = weight / weight.sum()
    step = 1.0 / (2 * (weight[:, None] * np.c_[x, np.ones(len(x))] ** 2).sum() + ridge)
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v + c))
        g = -2 * weight * y * slack
        w2, b2 = v - step * (x.T @ g + ridge * v), c - step * g.sum()
        pull = k / (k + 3)
        v, c = w2 + pull * (w2 - w), b2 + pull * (b2 - b)
        w, b = w2, b2
    return w, b


def shaped(evidence: np.ndarray) -> np.ndarray:
    most, total, rate = np.clip(evidence, -4, None).T
    return np.stack([most, np.log1p(total), np.minimum(rate, 5), np.ones(len(evidence))], axis=1)


@dataclass
class Model:
    weight: np.ndarray  # per bucket, float32
    bias: float
    curve: np.ndarray  # of the three numbers of a text's evidence, and offset

    def margins(self, units: list[str]) -> np.ndarray:
        """Margin of each unit (no longer than ``MAX_UNIT``)."""
        out = np.zeros(len(units))
        for i in range(0, len(units), 10_000):
            part = units[i : i + 10_000]
            raw, square = np.zeros(len(part)), np.zeros(len(part))
            for row, bucket, weight in _patterns(part):
                raw += weight * np.bincount(row, self.weight[bucket], len(part))
                square += weight * weight * np.bincount(row, minlength=len(part))
            out[i : i + len(part)] = raw / np.sqrt(np.where(square > 0, square, 1.0))
        return out + self.bias

    def window_margins(self, code: np.ndarray, size: np.ndarray, widths: tuple[int, ...] = (2, 3)) -> tuple[np.ndarray, ...]:
        """Margins of every two and every three neighbours joined (of every ``widths``), a mark framing the start.

        ``code``: the letters of all units, ``size`` of each.  A part of the
        letters at a time, so that the arrays stay in the cache.
        """
        end = np.cumsum(size)
        out: list[list[np.ndarray]] = [[] for _ in widths]
        at = 0
        while at < max(1, len(size)):
            before = end[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(end, before + LETTERS, "right")))
            last = min(stop + max(widths) - 1, len(size))  # windows that start here end so many units later at most
            for found, part in zip(out, self._windows_in(code[before : end[last - 1] if last else 0], size[at:last], widths)):
                found.append(part[: stop - at])
            at = stop
        return tuple(map(np.concatenate, out))

    def _windows_in(self, code: np.ndarray, size: np.ndarray, widths: tuple[int, ...] = (2, 3)) -> tuple[np.ndarray, ...]:
        """One pass over the letters: running sums, per reach, of the weights of the subsequences that start
        before a letter give the sum inside any window; norms depend on lengths only."""
        n, most = len(code), MOST_REACH
        code = np.concatenate([code, np.zeros(most, np.uint32)])
        end = np.cumsum(size)
        start = end - size
        inner = np.zeros((most + 1, n + 1))  # subsequences that start at a letter
        framed = np.zeros((most + 1, len(size)))  # ... at the mark before a unit
        times = np.zeros(most + 1)
        # Buckets are within the table: "wrap" only spares the check.
        for bucket, reach, _ in _keys(lambda r: code[r : r + n], code[:n]):
            inner[reach, 1:] += self.weight.take(bucket, mode="wrap")
            times[reach] += 1
        after = [code[start + r] for r in range(most)]
        for bucket, reach, _ in _keys(lambda r: after[r - 1], np.full(len(size), ord(START), np.uint32)):
            framed[reach] += self.weight.take(bucket, mode="wrap")
        spans = [(max(0, len(size) - many + 1), many - 1) for many in widths]
        lengths = [end[skip:] - start[:held] for held, skip in spans]
        raw = [np.zeros(held) for held, _ in spans]
        square = np.zeros(max((int(x.max()) for x in lengths if len(x)), default=0) + 1)  # by length
        for r in range(2, most + 1):
            sums = np.cumsum(inner[r])
            weight = DECAY ** (r + 1)
            first, last = sums[start], sums[np.maximum(end - r, 0)]
            for total, length, (held, skip) in zip(raw, lengths, spans):
                total += weight * ((last[skip:] - first[:held] + framed[r, :held]) * (length >= r))
            square += times[r] * weight * weight * np.maximum(0, np.arange(len(square)) + 1 - r)
        norm = np.sqrt(np.where(square > 0, square, 1.0))
        return tuple(total / norm[length] + self.bias for total, length in zip(raw, lengths))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """Score of each row (largest margin, positive sum, sum per hundred units)."""
        return 1 / (1 + np.exp(-np.clip(shaped(evidence) @ self.curve, -40, 40)))


#: Per code point: 1 for letters and digits that are their own lower case, 2 for others, 0 if not yet looked at.
_PLAIN = np.zeros(0x110000, np.uint8)


def _plain(code: np.ndarray) -> np.ndarray:
    kind = _PLAIN[code]
    if not kind.all():
        for c in np.unique(code[kind == 0]).tolist():
            _PLAIN[c] = 1 if chr(c).isalnum() and chr(c).lower() == chr(c) else 2
        kind = _PLAIN[code]
    return kind == 1


class Scorer:
    """Margins of texts.

    Arrow cuts a slice of texts to units and numbers the distinct ones; one
    pass over the letters of all units in order gives the margins of plain
    units and of windows.  Only units that have another form than themselves
    (marks inside, pieces) are taken apart one by one, once per worker while
    they are remembered.
    """

    LIMIT = 100_000
    LONGEST = 64  # longer units are not remembered

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}
        self.letters: dict[str, str] = {}  # of units that are not all letters and digits in lower case

    def unit_margins(self, units: list[str]) -> tuple[np.ndarray, list[str]]:
        """(the largest margin of each distinct unit's variants, each one's letters)."""
        if len(self.known) > self.LIMIT:
            self.known, self.letters = {}, {}
        known, letters = self.known, self.letters
        long: list[str] = []
        new = [u for u in units if u not in known]
        if new:
            forms = [variants(u) for u in new]
            margins = self.model.margins([p for f in forms for p in f])
            starts = np.cumsum([0, *map(len, forms[:-1])])
            known.update(zip(new, np.maximum.reduceat(margins, starts).tolist()))
            for u in new:
                if (low := letters_of(u)) != u:
                    letters[u] = low
            long = [u for u in new if len(u) > self.LONGEST]
        out = np.array([known[u] for u in units], float), [letters.get(u, u) for u in units]
        for u in long:
            del known[u]
            letters.pop(u, None)
        return out

    def spelled(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code points, where each unit's letters start among them, how many they are, margin of each unit).

        The margin is NaN for a plain unit: letters and digits in lower case, of one piece with its mark.
        """
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct), pa.scalar("", distinct.type))
        code = np.frombuffer(text[0].as_py().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
        size = pc.utf8_length(distinct).to_numpy().astype(np.int64)
        end = np.cumsum(size)
        start = end - size
        plain = np.concatenate([[0], np.cumsum(_plain(code))])
        other = np.flatnonzero((plain[end] - plain[start] != size) | (size == 0) | (size >= MAX_UNIT))
        margin = np.full(len(distinct), np.nan)
        if len(other):
            margin[other], letters = self.unit_margins(distinct.take(pa.array(other)).to_pylist())
            more, size[other] = codes_of(letters)
            start[other] = len(code) + np.cumsum(size[other]) - size[other]
            code = np.concatenate([code, more])
        return code, start, size, margin

    def evidence(self, texts) -> tuple[np.ndarray, list[str | None]]:
        """Of each text: (largest margin of its units and windows, sum of the positive ones, that sum per
        hundred units), and the worst of them; over all its sentences.

        Windows that hold a positive unit do not count; three units add what they have beyond their pairs.
        """
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        units = cut(texts)
        unit, text, sentence = units.unit, units.text, units.sentence
        n = len(texts)
        code, start, size, margins = self.spelled(units.distinct)
        # Runs of single characters, joined, are units too.
        extra, extra_text = spaced_runs(units)
        runs = {x: i for i, x in enumerate(dict.fromkeys(extra))}
        extra_margin = self.unit_margins(list(runs))[0][np.array([runs[x] for x in extra], np.intp)]

        margin = margins[unit]
        held = np.flatnonzero(size[unit] > 0)
        u, t, sent = unit[held], text[held], sentence[held]
        each = size[u]
        two = three = np.zeros(0)
        if len(u):
            ends = np.cumsum(each)
            place = np.repeat(start[u] - (ends - each), each) + np.arange(ends[-1])
            one, two, three = self.model.window_margins(code[place], each, (1, 2, 3))
            margin[held] = np.where(np.isnan(margin[held]), one, margin[held])
        own = margin[held] <= 0

        margin = np.concatenate([margin, extra_margin])
        of = np.concatenate([text, extra_text])
        count = np.bincount(of, minlength=n)
        total = np.bincount(of, np.maximum(margin, 0), n)
        most = np.full(n, -np.inf)
        np.maximum.at(most, of, margin)
        worst = np.full(n, -1)
        top = margin == most[of]
        worst[of[top][::-1]] = np.flatnonzero(top)[::-1]  # the first of equals

        joined = np.full(n, -1)
        many = np.zeros(n, np.int64)
        if len(u) > 1:
            pairs = own[:-1] & own[1:] & (sent[:-1] == sent[1:])
            triples = pairs[:-1] & pairs[1:]
            more = np.maximum(three - np.maximum(np.maximum(two[:-1], two[1:]), 0), 0)
            for width, found, counts, adds in ((2, two, pairs, np.maximum(two, 0)), (3, three, triples, more)):
                at = np.flatnonzero(counts)
                best = np.full(n, -np.inf)
                np.maximum.at(best, t[at], found[at])
                top = at[found[at] == best[t[at]]]
                top = top[found[top] > most[t[top]]]
                joined[t[top][::-1]], many[t[top][::-1]] = top[::-1], width
                most = np.maximum(most, best)
                total += np.bincount(t[at], adds[at], n)
        most[count == 0] = self.model.bias
        rate = 100 * total / np.maximum(count, 1)
        letters = lambda i: code[start[i] : start[i] + size[i]].tobytes().decode("utf-32-le", "surrogatepass")
        strings: list[str | None] = []
        for k in range(n):
            if not count[k]:
                strings.append(None)
            elif joined[k] >= 0:
                strings.append(START + "".join(letters(i) for i in u[joined[k] : joined[k] + many[k]]))
            else:
                w = worst[k]
                strings.append(variants(units.distinct[int(unit[w])].as_py() if w < len(unit) else extra[w - len(unit)])[0])
        return np.stack([most, total, rate], 1), strings

    def scores(self, texts) -> np.ndarray:
        return self.model.score(self.evidence(texts)[0])

    def sentences(self, text: str) -> list[tuple[str, float]]:
        """(sentence, score) of each sentence of a text."""
        parts = [s for s in _SENTENCE.split(text) if s.strip()]
        return list(zip(parts, self.scores(parts).tolist()))


_HELD: dict[str, Scorer] = {}


def scorer_for(name: str, model: Model) -> Scorer:
    """The worker's scorer of this name, kept from task to task."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Scorer(model)
    return _HELD[name]


def evidence_of(model: Model):
    """Column function: text -> struct(margin, total, rate, unit, score)."""
    name = uuid.uuid4().hex
    names = ("margin", "total", "rate", "unit", "score")
    schema = T.StructType([T.StructField(n, T.StringType() if n == "unit" else T.DoubleType()) for n in names])

    @F.arrow_udf(schema)
    def toxicity_evidence(texts: pa.Array) -> pa.Array:
        scorer, parts = scorer_for(name, model), []
        for some in slices(texts):
            found, units = scorer.evidence(some)
            columns = [pa.array(found[:, k]) for k in range(3)]
            parts.append(pa.StructArray.from_arrays(
                [*columns, pa.array(units, pa.string()), pa.array(model.score(found))], list(names)))
        return pa.concat_arrays(parts)

    return toxicity_evidence


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts, about a megabyte at a time; one empty slice of none."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    if not batch.num_rows:
        yield texts
    for some in words.slices(batch, 0):
        yield some.column(0)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _distinct_units(texts: pa.Array) -> pa.Array:
    parts = []
    for some in slices(texts):
        units = cut(some)
        forms = [[p for p in variants(u) if p != START] for u in units.names]
        extra, of = spaced_runs(units)
        found: list[set[str]] = [set() for _ in range(len(some))]
        for k, i in zip(units.text.tolist(), units.unit.tolist()):
            found[k].update(forms[i])
        for x, k in zip(extra, of.tolist()):
            found[k].update(variants(x))
        parts.append(pa.array([sorted(f) for f in found], pa.list_(pa.string())))
    return pa.concat_arrays(parts)


def window_id(units: list[str]) -> int:
    """Signed 64-bit hash of a window."""
    return xxhash.xxh3_64_intdigest(" ".join(units).encode("utf-8", "surrogatepass")) - (1 << 63)


def _raw_ids(units: list[str]) -> list[int]:
    """``window_id`` plus 2**63 of every two, then of every three neighbours."""
    each = [u.encode("utf-8", "surrogatepass") for u in units]
    two = list(map(b" ".join, zip(each, each[1:])))
    return list(map(xxhash.xxh3_64_intdigest, [*two, *map(b" ".join, zip(two, each[2:]))]))


def window_ids(text: str | None, bad: set[str]) -> np.ndarray:
    """Ids of a text's distinct windows in order, without those that hold a unit of ``bad``."""
    found: set[int] = set()
    for units in sentences_of(text):
        at = 0
        for k in [*(i for i, u in enumerate(units) if u in bad), len(units)]:
            found.update(_raw_ids(units[at:k]))
            at = k + 1
    ids = np.fromiter(found, np.uint64, len(found)) ^ np.uint64(1 << 63)
    return np.sort(ids.view(np.int64))


def _distinct_windows(bad: list[str]):
    """Column function: text -> ids of its distinct windows, without those that hold a unit of ``bad``."""
    held = {letters_of(u) for u in bad}

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def distinct_windows(texts: pa.Array) -> pa.Array:
        found = [window_ids(t.as_py(), held) for t in texts]
        bounds = np.cumsum([0, *map(len, found)])
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))

    return distinct_windows


def _spelled(ids: list[int]):
    """Column function: text -> its windows with one of ``ids``, units set apart by a blank."""
    wanted = {i + (1 << 63) for i in ids}

    def held(text: str | None) -> Iterator[str]:
        for units in sentences_of(text):
            for k, i in enumerate(_raw_ids(units)):
                if i in wanted:
                    at, many = (k, 2) if k < len(units) - 1 else (k - len(units) + 1, 3)
                    yield " ".join(units[at : at + many])

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def spelled(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(held(t.as_py()))) for t in texts], pa.list_(pa.string()))

    return spelled


def phrases(sample: DataFrame, bad: list[str]) -> tuple[list[str], list[str]]:
    """Joined windows of the sample: those beyond chance in toxic texts, and clean ones.

    Windows are counted by id; only the few that are chosen are spelled out.
    """
    seen = witnesses(sample.select("label", _distinct_windows(bad)(F.col("text")).alias("units")))
    if seen is None:
        return [], []
    beyond = seen.where("surprise is not null").orderBy(F.desc("surprise"), "unit").limit(UNITS)
    clean = seen.where("common and good > 0")
    often = clean.orderBy(F.desc("good"), "unit").limit(UNITS // 4)
    some = clean.orderBy(F.xxhash64("unit"), "unit").limit(UNITS // 4)
    toxic_ids = [r.unit for r in beyond.collect()]
    clean_ids = [r.unit for r in often.unionByName(some).select("unit").distinct().collect()]
    spelled = _spelled([*toxic_ids, *clean_ids])
    words_ = {window_id(w): w for r in sample.select(F.explode(spelled(F.col("text"))).alias("w")).distinct().collect()
              for w in (r.w.split(" "),)}
    toxic, held = [], set()
    for i in toxic_ids:
        w = words_[i]
        if len(w) == 2 or held.isdisjoint({(w[0], w[1]), (w[1], w[2])}):
            toxic.append(START + "".join(w))
            held.add(tuple(w))
    return toxic, sorted(START + "".join(words_[i]) for i in clean_ids)


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, text, units): about TOXIC_ROWS + CLEAN_ROWS labelled texts, near copies once.

    Copies are texts with the same least unit under each of three hashes; a
    group of them would otherwise vouch for its accidental words.
    """
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label"))
    size = dict(marked.groupBy("label").count().collect())
    picked = hash_sample(marked.where("label = 1"), TOXIC_ROWS, size.get(1, 0)).unionByName(
        hash_sample(marked.where("label = 0"), CLEAN_ROWS, size.get(0, 0)))
    # Broadcast: about TOXIC_ROWS + CLEAN_ROWS ids.
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Written first: else the filter on the units would have all texts cut before the join.
    rows = materialize(rows.select("label", "text"), "labelled-texts")
    rows = rows.select("label", "text", _distinct_units(F.col("text")).alias("units")).where(F.size("units") > 0)
    least = [F.array_min(F.transform("units", lambda u, k=k: F.xxhash64(F.lit(k), u))).alias(f"least{k}") for k in range(3)]
    rows = rows.select("*", *least).dropDuplicates([f"least{k}" for k in range(3)])
    return materialize(rows.select("label", "text", "units"), "toxic-sample")


def witnesses(sample: DataFrame) -> DataFrame | None:
    """(unit, bad, good, toxic): units of the sample with their text counts; ``toxic`` where beyond chance.

    The bar rises with the number of units common enough to pass, so that none does by chance.
    """
    size = dict(sample.groupBy("label").count().collect())
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return None
    per = materialize(sample.select("label", F.explode("units").alias("unit")).groupBy("unit").agg(
        F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")), "toxic-units")
    share = toxic / (toxic + clean)
    n = F.col("bad") + F.col("good")
    rate = (F.col("bad") + 0.01) / (n + 0.02)
    surprise = F.col("bad") * F.log(rate / share) + F.col("good") * F.log((1 - rate) / (1 - share))
    bar = float(np.log(max(per.where(n >= 5).count(), 1))) + 3
    return per.select("unit", "bad", "good", (rate < share).alias("common"),
                      F.when((rate > 0.8) & (surprise > bar), surprise).alias("surprise"))


def spread_out(units: list[str], count: int, seed: int = 1) -> list[str]:
    """Up to ``count`` units, each next the least like those chosen (farthest first)."""
    rng = np.random.default_rng(seed)
    pool = [units[i] for i in rng.permutation(len(units))[:POOL]]
    if len(pool) <= count:
        return pool
    row, bucket, weight = subsequences(pool)
    weight = weight / norms(len(pool), row, weight)[row]
    chosen, close = [0], np.zeros(len(pool))
    while len(chosen) < count:
        last = np.zeros(BUCKETS)
        mine = row == chosen[-1]
        np.add.at(last, bucket[mine], weight[mine])
        close = np.maximum(close, np.bincount(row, weight * last[bucket], len(pool)))
        close[chosen] = np.inf
        chosen.append(int(close.argmin()))
    return [pool[i] for i in chosen]


def fit(bad: list[str], good: list[str], counts: np.ndarray, hard: list[str]) -> Model:
    """Nyström machine for toxic units against clean ones; ``hard`` clean units get landmarks of their own."""
    marks = spread_out(bad, LANDMARKS // 2) + spread_out(good, LANDMARKS // 4) + spread_out(hard, LANDMARKS // 4)
    table = landmark_table(marks)
    own = kernel(marks, table)
    value, vector = np.linalg.eigh((own + own.T) / 2)
    held = value > 1e-3 * value.max()
    root = vector[:, held] / np.sqrt(value[held])
    x = kernel(bad + good, table) @ root
    y = np.r_[np.ones(len(bad)), -np.ones(len(good))]
    w, bias = fit_svm(x, y, np.r_[np.full(len(bad), 1 / len(bad)), counts / counts.sum()])
    folded = (table.weight @ (root @ w).astype(np.float32))[table.index]
    return Model(folded, float(bias), np.array([1.0, 0, 0, 0]))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model of ``labels.toxic``; None without a unit or window that marks toxic texts."""
    ship_code(docs.sparkSession)
    sample = labelled_sample(docs, labels)
    units = witnesses(sample)
    bad = [] if units is None else [
        r.unit for r in units.where("surprise is not null").orderBy(F.desc("surprise"), "unit").limit(UNITS).collect()]
    clean = None if units is None else units.where("common and good > 0")
    if clean is None or clean.isEmpty():
        return None
    often = clean.orderBy(F.desc("good"), "unit").limit(UNITS // 2)
    some = clean.orderBy(F.xxhash64("unit"), "unit").limit(UNITS // 2)
    counts = dict(often.unionByName(some).select("unit", "good").collect())
    toxic, fine = phrases(sample, bad)
    bad = list(dict.fromkeys(bad + toxic))
    if not bad:
        return None
    counts.update((u, 1) for u in sorted(set(fine).difference(counts, bad)))
    model, hard = fit(bad, list(counts), np.log1p(np.array(list(counts.values()), float)), []), []
    for _ in range(REFITS):  # the worst unit or window of each clean text joins the clean class, of each toxic text the other
        worst = sample.select("label", evidence_of(model)(F.col("text"))["unit"].alias("unit")).join(units, "unit", "left").where("unit is not null")
        hard = [r.unit for r in worst.where("label = 0").groupBy("unit").agg(F.count("*").alias("n")).orderBy(
            F.desc("n"), "unit").limit(UNITS).collect()]
        more = [r.unit for r in worst.where("label = 1 and good = 0 and bad > 1").select("unit").distinct().orderBy("unit").limit(UNITS).collect()]
        bad = list(dict.fromkeys(bad + more))
        counts.update((u, counts.get(u, 1)) for u in hard)
        model = fit(bad, list(counts), np.log1p(np.array(list(counts.values()), float)), hard)
    found = sample.select("label", evidence_of(model)(F.col("text")).alias("e")).select("label", "e.margin", "e.total", "e.rate").toPandas()
    model.curve = calibrate(found[["margin", "total", "rate"]].to_numpy(float), found["label"].to_numpy(float))
    return model


def calibrate(evidence: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic curve over a text's evidence by Newton steps, both labels weighing the same; no term may fall."""
    weight = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    x, free = shaped(evidence), np.array([True] * 4)
    while True:
        at, used = np.zeros(4), np.flatnonzero(free)
        ridge = np.diag([3e-3, 3e-3, 3e-3, 1e-6])[np.ix_(used, used)]
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            grad = x[:, used].T @ (weight * (p - label)) + ridge @ at[used]
            hess = (x[:, used] * (weight * p * (1 - p))[:, None]).T @ x[:, used] + ridge + 1e-9 * np.eye(len(used))
            at[used] -= np.clip(np.linalg.solve(hess, grad), -2, 2)
        falling = (at[:3] < 0) & free[:3]
        if not falling.any():
            return at
        free[:3] &= ~falling


def score_documents(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, margin, score) of every row."""
    ship_code(docs.sparkSession)
    if model is None:
        return docs.select(key, F.lit(0.0).alias("margin"), F.lit(0.0).alias("score"))
    name = uuid.uuid4().hex

    def scored(batches):
        # Results go out a slice of texts at a time, so that a worker holds few.
        scorer = scorer_for(name, model)
        for batch in batches:
            for some in words.slices(batch, 1):
                found, _ = scorer.evidence(some.column(1))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(found[:, 0]), pa.array(model.score(found))], [key, "margin", "score"])

    schema = T.StructType([docs.schema[key], T.StructField("margin", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(scored, schema)
