"""Periodic runs of words by block convolution.

A *run* is a stretch of a text's words with smallest period ``q`` (words ``q``
apart are identical), at least ``max(min_words, 3 * q)`` words long, that no
neighbouring word extends keeping the period.

At scale ``B = 8, 16, 32, ...`` the words are cut into blocks of ``B`` and the
periods ``B <= q < 2 * B`` (at the first scale ``1 <= q < 16``) are looked for.
The words of a run that also occur ``q`` words later number two periods or
more, so they hold a whole block of that scale.  A number-theoretic transform
gives the sum of squared differences between the block and the window behind
it at every distance, modulo two primes and so exactly below their product; a
zero is an occurrence.  Its distance seeds an extension to both sides over the
words themselves, which yields the run.

Two exact cuts keep the transforms few: a block with a word that does not
recur within ``2 * B`` words has no occurrence, and one that lies with its
window inside a run of a smaller period yields only multiples of that period.

Several texts share one array, divided by numbers that occur once.

Defined results: a null or empty text has no words and no runs; repeated rows
give repeated results; a very long text is worked on whole, alone; other
columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm import words
from parcelspark.llm.common import ship_code

MIN_WORDS = 24
TIMES = 3
FIRST = 8
#: Primes with roots of unity of every order up to 2^26; (prime, primitive root).
PRIMES = ((2013265921, 31), (469762049, 3))
#: Numbers in one batch of transforms.
_NUMBERS = 1 << 18


@functools.lru_cache(maxsize=128)
def _roots(size: int, prime: int, root: int, inverse: bool) -> np.ndarray:
    step = pow(root, (prime - 1) // size, prime)
    if inverse:
        step = pow(step, prime - 2, prime)
    powers = np.ones(size // 2, np.uint64)
    known = 1
    while known < len(powers):  # doubling: w^(i + known) = w^i * w^known
        more = min(known, len(powers) - known)
        powers[known : known + more] = powers[:more] * np.uint64(pow(step, known, prime)) % np.uint64(prime)
        known += more
    return powers


def ntt(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Transform of each row (numbers below ``prime``), in bit-reversed order."""
    n, p = rows.shape[1], np.uint64(prime)
    a, half = rows, n // 2
    while half:
        w = _roots(2 * half, prime, root, False)
        a = a.reshape(-1, 2, half)
        low, high = a[:, 0], a[:, 1]
        a = np.stack([(low + high) % p, (low + p - high) * w % p], 1)
        half //= 2
    return a.reshape(rows.shape)


def inverse_ntt(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Inverse of ``ntt``, from bit-reversed to natural order."""
    n, p = rows.shape[1], np.uint64(prime)
    a, half = rows, 1
    while half < n:
        w = _roots(2 * half, prime, root, True)
        a = a.reshape(-1, 2, half)
        low, high = a[:, 0], a[:, 1] * w % p
        a = np.stack([(low + high) % p, (low + p - high) % p], 1)
        half *= 2
    return a.reshape(rows.shape) * np.uint64(pow(n, prime - 2, prime)) % p


def block_matches(numbers: np.ndarray, at: np.ndarray, size: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """(block index, distance) of every occurrence of the blocks at ``at`` near to far words later.

    ``numbers`` must go on for ``far + size`` numbers behind each block.
    """
    count, width = far - near + 1, far - near + size
    n = 1 << (width + size - 1 - 1).bit_length() if size == FIRST else 1 << (width - 1).bit_length()
    found_block, found_far = [], []
    rows = max(1, _NUMBERS // n)
    for i in range(0, len(at), rows):
        some = at[i : i + rows, None]
        block = numbers[some + np.arange(size)]
        window = numbers[some + near + np.arange(width)]
        zero = np.ones((len(some), count), bool)
        for prime, root in PRIMES:
            p = np.uint64(prime)
            a, b = np.zeros((2, len(some), n), np.uint64)
            a[:, :size] = block[:, ::-1].astype(np.uint64) % p
            b[:, :width] = window.astype(np.uint64) % p
            both = inverse_ntt(ntt(a, prime, root) * ntt(b, prime, root) % p, prime, root)[:, size - 1 : size - 1 + count]
            own = (a * a % p).sum(1, dtype=np.uint64)[:, None] % p
            sums = np.cumsum(b[:, :width] * b[:, :width] % p, 1, dtype=np.uint64)
            theirs = sums[:, size - 1 :].copy()
            theirs[:, 1:] -= sums[:, : count - 1]
            zero &= (own + theirs + (p - both) * np.uint64(2)) % p == 0
        r, d = np.nonzero(zero)
        found_block.append(r + i)
        found_far.append(d + near)
    if not found_block:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_block), np.concatenate(found_far)


def _inside(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int]], below: int) -> np.ndarray:
    """Which stretches [a, b) lie in one of ``runs`` (start, end, period) with a period under ``below``."""
    known = sorted((s, e) for s, e, q in runs if q < below)
    if not known:
        return np.zeros(len(a), bool)
    starts = np.array([s for s, _ in known])
    ends = np.maximum.accumulate(np.array([e for _, e in known]))
    i = np.searchsorted(starts, a, "right") - 1
    return (i >= 0) & (ends[np.maximum(i, 0)] >= b)


def _same(numbers: np.ndarray, i: int, j: int, most: int, step: int) -> int:
    """How many of ``most`` pairs from (i, j) on, going by ``step``, are equal before the first that is not."""
    done, chunk = 0, 64
    while done < most:
        n = min(chunk, most - done)
        if step > 0:
            x, y = numbers[i + done : i + done + n], numbers[j + done : j + done + n]
        else:
            x, y = numbers[i - done - n + 1 : i - done + 1][::-1], numbers[j - done - n + 1 : j - done + 1][::-1]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done, chunk = done + n, chunk * 2
    return done


def find_runs(numbers: np.ndarray, min_words: int = MIN_WORDS, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run, sorted by start, then period.

    ``numbers`` stand for words; one that occurs once divides texts.
    ``min_words`` of 24 or more and ``times`` of 3 or more.
    """
    if min_words < 3 * FIRST or times < 3:
        raise ValueError(f"runs of {3 * FIRST} words and 3 periods at least")
    n = len(numbers)
    order = np.argsort(numbers, kind="stable")
    recurs = np.full(n, 1 << 60)  # words to the same word's next occurrence
    again = numbers[order[1:]] == numbers[order[:-1]]
    recurs[order[:-1][again]] = (order[1:] - order[:-1])[again]
    runs: list[tuple[int, int, int]] = []
    size = FIRST
    longest = int(np.diff(np.concatenate([[-1], np.flatnonzero(_alone(numbers, order, again)), [n]])).max()) if n else 0
    while size <= longest // times:
        near, far = (1, 2 * size - 1) if size == FIRST else (size, 2 * size - 1)
        whole = n // size * size
        at = np.arange(0, whole, size)
        at = at[recurs[:whole].reshape(-1, size).max(1) <= far]
        at = at[~_inside(at, at + 3 * size, runs, size)]
        if len(at):
            # No word has the number that fills the windows behind the last one.
            behind = np.full(3 * size, numbers.max() + 1, numbers.dtype)
            block, q = block_matches(np.concatenate([numbers, behind]), at, size, near, far)
            _extend(numbers, at[block], q, size, runs, min_words, times)
        size *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _alone(numbers: np.ndarray, order: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Marks the numbers that occur once."""
    once = np.ones(len(numbers), bool)
    once[order[1:][again]] = False
    once[order[:-1][again]] = False
    return once


def _extend(numbers: np.ndarray, at: np.ndarray, q: np.ndarray, size: int, runs: list, min_words: int, times: int) -> None:
    """Extend each occurrence at distance ``q`` to its stretch and add those that are runs to ``runs``."""
    n = len(numbers)
    for period in np.unique(q).tolist():
        starts = np.sort(at[q == period])
        # Every divisor of a period in this scale is below the scale's size.
        starts = starts[~_inside(starts, starts + period + size, runs, min(size, period))]
        i = 0
        while i < len(starts):
            p = int(starts[i])
            first = p - _same(numbers, p - 1, p - 1 + period, p, -1)
            last = p + _same(numbers, p, p + period, n - p - period, 1) + period
            if last - first >= max(min_words, times * period) and not _inside(
                    np.array([first]), np.array([last]), runs, min(size, period))[0]:
                runs.append((first, last, period))
            i = max(i + 1, int(np.searchsorted(starts, last - period)))


RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def collapse(docs: DataFrame, min_words: int = MIN_WORDS, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, text): every row's runs and its text without their repeats.

    ``runs`` are (start, length, period) by start, then period.  ``text`` has
    the words, joined by one space, that no run contains after its first period.
    """
    ship_code(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("text", T.StringType())])

    def of_batches(batches):
        for batch in batches:
            for some in words.slices(batch, 1):
                yield _of_slice(some, min_words, times)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(of_batches, schema)


def _of_slice(some: pa.RecordBatch, min_words: int, times: int) -> pa.RecordBatch:
    flat, bounds = words.split(some.column(1))
    coded = flat.dictionary_encode()
    vocabulary, n_docs = len(coded.dictionary), len(bounds) - 1
    # One number between two texts, each its own.
    numbers = np.empty(len(flat) + n_docs, np.int64)
    divided = bounds[1:] + np.arange(n_docs)
    is_word = np.ones(len(numbers), bool)
    is_word[divided] = False
    numbers[is_word] = coded.indices.to_numpy()
    numbers[divided] = vocabulary + np.arange(n_docs)
    found = find_runs(numbers, min_words, times)
    starts = bounds[:-1] + np.arange(n_docs)
    keep = np.ones(len(numbers), bool)
    for s, e, q in found:
        keep[s + q : e] = False
    s, e, q = np.array(found, np.int64).reshape(-1, 3).T
    doc = np.searchsorted(starts, s, "right") - 1
    cuts = np.searchsorted(doc, np.arange(n_docs + 1))
    values = pa.StructArray.from_arrays([pa.array(s - starts[doc]), pa.array(e - s), pa.array(q)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [some.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values),
         words.join(flat, bounds, keep[is_word]).cast(pa.string())],
        ["doc_id", "n_words", "runs", "text"])


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period (ties: smallest start, then period); null if there is none."""
    def order(x, y):
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(left > right, -1).when(left < right, 1)
                .when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).otherwise(1))

    return F.aggregate(
        runs, F.lit(None).cast(RUN.simpleString()),
        lambda best, x: F.when(best.isNull() | (order(x, best) < 0), x).otherwise(best))
