"""Substring dedup by level-wise doubling of repeated word windows.

Window lengths double from level to level up to the asked one (7 -> 13, or
7 -> 13 -> 26 -> 52): a window is made of two windows of the level below, one
at its start and one at its end, so only where both are repeated is it hashed
and counted at all.  The levels end early when nothing is left.

The lowest two levels:

* *Anchors.*  Of the grams of ``(n + 1) / 2`` words in a window of ``n``, the
  one with the smallest hash (the leftmost of equals) is its anchor.  Equal
  windows have equal anchors at equal places, so a window can be repeated only
  if its anchor's gram is.  About a quarter of the grams are anchors, and only
  they are counted.
* *Windows* whose anchors are repeated are counted by a 128-bit hash of their
  words.

A level's table has one row per repeated gram or window: its smallest
``doc_id`` and number of rows; it is made by a grouping with map-side partial
sums.  Rows find their table entry by ``meet``, which keeps entries that hold
a large share of the rows out of the shuffle.  Marks go back to the texts as
intervals of window starts, one row per text.

Exact copies are settled before: of rows with one text only those with the
smallest ``doc_id`` take part in the levels.

Defined results: a null or empty text has no words; rows that share a
``doc_id`` do not make each other's windows repeated; rows without a
``doc_id`` neither repeat others nor lose words; texts shorter than a window
lose nothing; very long texts are read whole, a slice of texts at a time;
other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm import words
from parcelspark.llm.common import broadcast_if_small, fresh, materialize, ship_code

WINDOW = 13
#: Shortest grams that are worth counting.
LEAST = 7
#: At most so many entries count as hot: those that hold over 1 / HOT of the rows.
HOT = 1 << 14
#: A table of repeated grams is one number a row; so many may be broadcast.
BROADCAST_GRAMS = 4_000_000
#: End of an interval that reaches to the end of a text.
_OPEN = (1 << 40) - 1
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def levels(window: int) -> list[int]:
    """Window lengths, shortest first; each but the first is covered by two of the one before."""
    out = [window]
    while (out[0] + 1) // 2 >= LEAST:
        out.insert(0, (out[0] + 1) // 2)
    return out


def word_hashes(flat: pa.Array) -> np.ndarray:
    """(2, n) hashes of words, each distinct word hashed once."""
    coded = flat.dictionary_encode()
    known = b"".join([xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist()])
    return np.frombuffer(known, np.uint64).reshape(-1, 2).T[:, coded.indices.to_numpy()]


def gram_hashes(hashes: np.ndarray, multiplier: np.uint64, n: int) -> np.ndarray:
    """Hash of the ``n`` words from every place on (polynomial, then mixed); zero where fewer are left."""
    out = np.zeros(len(hashes), np.uint64)
    size = len(hashes) - n + 1
    if size > 0:
        h = np.zeros(size, np.uint64)
        for j in range(n):
            h = h * multiplier + hashes[j : j + size]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        out[:size] = h
    return out


def anchors_of(flat: pa.Array, bounds: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """(text, gram hash, lo, hi): windows starting at words lo..hi of a text have this anchor."""
    starts, lengths = bounds[:-1], np.diff(bounds)
    texts = np.flatnonzero(lengths >= window)
    if not len(texts):
        return (np.zeros(0, np.int64),) * 4
    h = gram_hashes(word_hashes(flat)[0], _MULTIPLIERS[0], gram)
    wide = window - gram + 1
    best, at = h.copy(), np.arange(len(h))
    for k in range(1, wide):  # leftmost smallest of the grams at i .. i + wide - 1
        other = h[k:]
        less = np.flatnonzero(other < best[: len(other)])
        best[less], at[less] = other[less], less + k
    count = lengths[texts] - window + 1
    of = np.repeat(texts, count)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    anchor = at[starts[of] + place]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])]))
    last = np.concatenate([first[1:], [len(of)]]) - 1
    return of[first], h[anchor[first]], place[first], place[last]


def windows_of(flat: pa.Array, bounds: np.ndarray, allowed: list, window: int, shift: int) -> tuple[np.ndarray, ...]:
    """(text, start, h1, h2) of windows: the texts' intervals ``allowed`` [{lo, hi}, ...] hold their starts, also ``shift`` on."""
    texts = np.repeat(np.arange(len(allowed)), [len(a) for a in allowed])
    spans = np.array([(s["lo"], s["hi"]) for a in allowed for s in a], np.int64).reshape(-1, 2)
    count = spans[:, 1] - spans[:, 0] + 1
    of = np.repeat(texts, count)
    start = np.repeat(spans[:, 0], count) + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    if shift:
        place = (of << 40) + start
        both = np.isin(place + shift, place)
        of, start = of[both], start[both]
    hashes = word_hashes(flat)
    at = bounds[of] + start
    return of, start, *(gram_hashes(hashes[i], _MULTIPLIERS[i], window)[at] for i in (0, 1))


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _text_id(docs: DataFrame) -> list[Column]:
    """What rows of one text and ``doc_id`` share: the columns ``d`` and ``t``."""
    return [F.col("doc_id").alias("d"), F.xxhash64("text").alias("t")]


def meet(rows: DataFrame, entries: DataFrame, keys: list[str], total: int, how: str) -> DataFrame:
    """``rows`` joined with ``entries`` (one row per key, column ``n``: its number of rows).

    Entries with over ``total / HOT`` rows are fewer than ``HOT`` and are
    broadcast; rows that met one of them take part in the shuffle join under
    keys of their own, so no key gathers many rows in one task.
    """
    values = [c for c in entries.columns if c not in keys]
    often = entries.where(F.col("n") > total // HOT)
    hot = F.broadcast(often.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(v).alias(f"hot_{v}") for v in values]))
    met = rows.join(hot, [rows[k] == F.col(f"_{k}") for k in keys], "left")
    is_hot = F.col("hot_n").isNotNull()
    spread = F.xxhash64(*[F.col(c) for c in rows.columns])
    met = met.select(*rows.columns, *[f"hot_{v}" for v in values],
                     *[F.when(is_hot, spread).otherwise(F.col(k)).alias(f"_{k}") for k in keys], is_hot.alias("_hot"))
    rest = entries.where(F.col("n") <= total // HOT).select(
        *[F.col(k).alias(f"{k}_") for k in keys], *[F.col(v).alias(f"cold_{v}") for v in values], F.lit(False).alias("_cold"))
    out = met.join(rest, [F.col(f"_{k}") == F.col(f"{k}_") for k in keys] + [F.col("_hot") == F.col("_cold")], "left")
    out = out.select(*rows.columns, *[F.coalesce(f"hot_{v}", f"cold_{v}").alias(v) for v in values])
    return out.where(F.col("n").isNotNull()) if how == "inner" else out


def repeated(rows: DataFrame, keys: list[str], purpose: str) -> tuple[DataFrame, int]:
    """Entries (keys, first_doc, n) of the keys that two documents hold, and the number of rows of all entries."""
    found = rows.groupBy(*keys).agg(F.min("d").alias("first_doc"), F.max("d").alias("last_doc"), F.count(F.lit(1)).alias("n"))
    found = materialize(found.where("first_doc < last_doc").drop("last_doc"), purpose)
    return found, found.agg(F.sum("n")).first()[0] or 0


def _merged(batches):
    """Each row's intervals (sorted by lo) with neighbours and overlaps joined."""
    for batch in batches:
        lists = batch.column(2)
        flat = lists.flatten()
        lo, hi = (flat.field(c).to_numpy() for c in ("lo", "hi"))
        of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        reach = np.maximum.accumulate(hi + (of << 40))  # a later row's numbers are all greater
        new = np.concatenate([[True], lo[1:] + (of[1:] << 40) > reach[:-1] + 1])[: len(lo)]
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(lo)]])[: len(first)] - 1
        ends = reach[last] - (of[first] << 40)
        cuts = np.searchsorted(of[first], np.arange(batch.num_rows + 1))
        spans = pa.StructArray.from_arrays([pa.array(lo[first]), pa.array(ends)], ["lo", "hi"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans)], ["d", "t", "spans"])


def _intervals(marks: DataFrame, purpose: str) -> DataFrame:
    """(d, t, spans): the marks (d, t, lo, hi) of a text as disjoint intervals, neighbours joined."""
    lists = marks.groupBy("d", "t").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    return materialize(lists.mapInArrow(_merged, lists.schema), purpose)


def later_copies(docs: DataFrame) -> DataFrame:
    """(d, t) of the rows whose whole text a smaller ``doc_id`` has too."""
    rows = docs.where("doc_id is not null and text is not null").select(*_text_id(docs), F.xxhash64(F.lit(7), "text").alias("u"))
    entries, total = repeated(rows, ["t", "u"], "copied-texts")
    found = meet(rows, entries, ["t", "u"], total, "inner").where("d > first_doc")
    return materialize(found.select("d", "t").distinct(), "later-copies")


def _anchors(source: DataFrame, gram: int, window: int) -> DataFrame:
    """(d, t, lo, hi, g) of every anchor."""
    def of_batches(batches):
        for batch in batches:
            for some in words.slices(batch, 2):
                flat, bounds = words.split(some.column(2))
                of, g, lo, hi = anchors_of(flat, bounds, gram, window)
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(rows), some.column(1).take(rows), pa.array(lo), pa.array(hi), _signed(g)],
                    ["d", "t", "lo", "hi", "g"])

    schema = T.StructType([source.schema["d"], source.schema["t"], *[T.StructField(c, T.LongType()) for c in ("lo", "hi", "g")]])
    return source.mapInArrow(of_batches, schema)


def _windows(source: DataFrame, spans: DataFrame, window: int, shift: int) -> DataFrame:
    """(d, t, start, h1, h2) of the windows at the starts in ``spans`` that ``spans`` also holds ``shift`` words on."""
    def of_batches(batches):
        for batch in batches:
            for some in words.slices(batch, 2):
                flat, bounds = words.split(some.column(2))
                of, start, h1, h2 = windows_of(flat, bounds, some.column(3).to_pylist(), window, shift)
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(rows), some.column(1).take(rows), pa.array(start), _signed(h1), _signed(h2)],
                    ["d", "t", "start", "h1", "h2"])

    few = broadcast_if_small(spans).select(F.col("d").alias("_d"), F.col("t").alias("_t"), "spans")
    met = source.join(few, (source["d"] == F.col("_d")) & (source["t"] == F.col("_t"))).select("d", "t", "text", "spans")
    schema = T.StructType([source.schema["d"], source.schema["t"], *[T.StructField(c, T.LongType()) for c in ("start", "h1", "h2")]])
    return met.mapInArrow(of_batches, schema)


def find_removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(d, t, spans): word intervals to remove, only for texts that lose any.

    A later copy's interval is open-ended; it holds for texts of ``window``
    words or more.
    """
    ship_code(docs.sparkSession)
    copies = later_copies(docs)
    whole = copies.select("d", "t", F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(_OPEN).cast("long").alias("hi"))).alias("spans"))
    no_copy = broadcast_if_small(copies).select(F.col("d").alias("_d"), F.col("t").alias("_t"))
    source = docs.where("doc_id is not null and text is not null").select(*_text_id(docs), "text")
    source = source.join(no_copy, (source["d"] == F.col("_d")) & (source["t"] == F.col("_t")), "left_anti")

    sizes = levels(window)
    anchors = _anchors(source, sizes[0], sizes[1] if len(sizes) > 1 else sizes[0])
    entries, total = repeated(anchors, ["g"], "repeated-grams")
    grams = broadcast_if_small(entries.select(F.col("g").alias("_g")), BROADCAST_GRAMS)
    if total and entries.count() <= BROADCAST_GRAMS:
        marks = anchors.join(grams, F.col("g") == F.col("_g"), "left_semi")
    else:
        marks = meet(anchors, entries, ["g"], total, "inner")
    shift = 0
    for size, wider in zip(sizes[1:] or sizes, [*sizes[2:], None]):
        if not total:
            return whole
        spans = _intervals(marks.select("d", "t", "lo", "hi"), f"candidates-{size}")
        rows = _windows(source, spans, size, shift)
        entries, total = repeated(rows, ["h1", "h2"], f"repeated-{size}")
        found = meet(rows, entries, ["h1", "h2"], total, "inner")
        if wider:
            marks, shift = found.select("d", "t", F.col("start").alias("lo"), F.col("start").alias("hi")), wider - size
    gone = found.where("d > first_doc").select("d", "t", F.col("start").alias("lo"), (F.col("start") + size - 1).alias("hi"))
    return _intervals(gone, "removed-words").unionByName(whole)


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])


def _without(some: pa.RecordBatch, text: int, spans: int, window: int) -> pa.StructArray:
    """(n_words, n_removed, kept words joined by one space) of the texts in column ``text``."""
    flat, bounds = words.split(some.column(text).cast(pa.string()))
    keep = np.ones(len(flat), bool)
    for i in np.flatnonzero(some.column(spans).is_valid().to_numpy(zero_copy_only=False)).tolist():
        a, b = int(bounds[i]), int(bounds[i + 1])
        if b - a >= window:
            for s in some.column(spans)[i].as_py():
                keep[a + s["lo"] : min(a + s["hi"] + 1, b)] = False
    left = np.concatenate([[0], np.cumsum(keep)])[bounds]
    n = np.diff(bounds)
    return pa.StructArray.from_arrays(
        [pa.array(n), pa.array(n - np.diff(left)), words.join(flat, bounds, keep).cast(pa.string())],
        ["n_words", "n_removed", "text"])


def dedup(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, str]:
    """``docs`` plus one struct column (n_words, n_removed, text of the kept words); its name."""
    d, t, gone_words = fresh(docs, "_d"), fresh(docs, "_t"), fresh(docs, "_spans")
    gone = broadcast_if_small(materialize(find_removed(docs, window), "removed")).select(
        F.col("d").alias(d), F.col("t").alias(t), F.col("spans").alias(gone_words))

    name = fresh(docs, "substring_result")
    out = docs.join(gone, (docs["doc_id"] == F.col(d)) & (F.xxhash64(docs["text"]) == F.col(t)), "left")
    out = out.select(*[docs[c] for c in docs.columns], gone_words)
    text, spans = docs.columns.index("text"), len(docs.columns)

    def without(batches):
        # A slice of texts at a time, so that a worker holds few results.
        for batch in batches:
            for some in words.slices(batch, text):
                kept = _without(some, text, spans, window)
                yield pa.RecordBatch.from_arrays([*some.columns[:spans], kept], [*some.schema.names[:spans], name])

    return out.mapInArrow(without, T.StructType([*docs.schema.fields, T.StructField(name, RESULT)])), name
