"""Token files of patched frame-of-reference blocks.

A file is a run of records, each closed by one line feed:

* block ``PFB1``: value count, minimum, bit width, exception count, index of
  the first value in the file; the values less the minimum, packed at the
  width that ``PERCENTILE`` of them fit; then the exception list (positions,
  full values) of those that do not;
* documents ``PFD1``: ids (with a flag byte for null) and token counts of the
  documents that end in the blocks since the last such record;
* footer ``PFE1``, last: partition number, totals and, per block, its byte
  offset and first value index, then the byte offset of each documents record;
  its length and magic end the file, so a reader finds any block without
  scanning (``TokenFile.tokens``).

Documents are range-partitioned and sorted by ``doc_id``; each partition
streams its records through Spark's own file writer, which commits whole files
on any file system, also after retries.  The number of partitions grows with
the measured bytes of texts (``FILE_BYTES`` a file), so files stay bounded.  They
are read as binary files; a reader unpacks one block at a time.

Defined results: a null or empty text is the end id alone; repeated rows are
written again, ties ordered by text hash; rows without ``doc_id`` come first;
very long texts span blocks.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm import words
from parcelspark.llm.common import broadcast_if_small, materialize, ship_code

BLOCK_VALUES = 1 << 15
#: Bytes of texts that one file is meant for.
FILE_BYTES = 256 << 20
PERCENTILE = 0.97
END_ID = 1
#: Text bytes encoded at a time: more share more of their distinct words.
SLICE_BYTES = 4 << 20

_BLOCK = struct.Struct("<4sIIBIQI")
_DOCS = struct.Struct("<4sI")
_FOOT = struct.Struct("<4sIQQII")
_TAIL = struct.Struct("<Q4s")


def pack_block(values: np.ndarray, first: int, percentile: float = PERCENTILE) -> bytes:
    """One block record of up to 2^32 unsigned 32-bit values."""
    values = values.astype(np.uint32)
    low = int(values.min())
    rest = values - np.uint32(low)
    bits = np.ceil(np.log2(rest.astype(np.float64) + 1)).astype(np.int64)
    width = int(np.quantile(bits, percentile, method="inverted_cdf"))
    over = np.flatnonzero(bits > width).astype("<u4")
    plane = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(plane.ravel(), bitorder="little").tobytes()
    head = _BLOCK.pack(b"PFB1", len(values), low, width, len(over), first, len(packed))
    return head + packed + over.tobytes() + values[over].astype("<u4").tobytes()


def unpack_block(record: memoryview, at: int = 0) -> tuple[np.ndarray, int]:
    """(values, byte after the record)."""
    magic, n, low, width, n_over, _, size = _BLOCK.unpack_from(record, at)
    if magic != b"PFB1":
        raise ValueError("not a block")
    at += _BLOCK.size
    bits = np.unpackbits(np.frombuffer(record, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    plane = np.zeros((n, 32), np.uint8)
    plane[:, :width] = bits
    values = np.packbits(plane, axis=1, bitorder="little").view("<u4").ravel() + np.uint32(low)
    at += size
    over = np.frombuffer(record, "<u4", n_over, at)
    values[over] = np.frombuffer(record, "<u4", n_over, at + 4 * n_over)
    return values, at + 8 * n_over


def block_starts(content: bytes) -> list[tuple[int, int]]:
    """(byte offset, first value index) of each block, from the footer alone."""
    return TokenFile(content).blocks.tolist()


def _footer_at(content: bytes) -> int:
    size, magic = _TAIL.unpack_from(content, len(content) - _TAIL.size - 1)
    if magic != b"PFE1":
        raise ValueError("file has no footer")
    return len(content) - 1 - _TAIL.size - size


def write_records(part: int, documents: Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]) -> Iterator[bytes]:
    """Records of one file from (doc_ids, ids of all of them, number of ids of each) in order.

    Memory: eight blocks, one of these groups, and the documents of both.
    """
    pending: list[np.ndarray] = []
    ids: list[int | None] = []
    counts: list[int] = []
    starts: list[tuple[int, int]] = []
    records: list[int] = []
    held = written = offset = total_docs = 0

    def flush(everything: bool) -> Iterator[bytes]:
        nonlocal pending, held, written, offset, total_docs, ids, counts
        if held:
            values = np.concatenate(pending)
            stop = held if everything else held - held % BLOCK_VALUES
            for i in range(0, stop, BLOCK_VALUES):
                part_values = values[i : min(i + BLOCK_VALUES, stop)]
                record = pack_block(part_values, written)
                starts.append((offset, written))
                offset += len(record) + 1
                written += len(part_values)
                yield record
            pending, held = [values[stop:]] if stop < held else [], held - stop
        if ids:
            record = _DOCS.pack(b"PFD1", len(ids))
            record += np.array([i is None for i in ids], np.uint8).tobytes()
            record += np.array([i or 0 for i in ids], "<i8").tobytes() + np.array(counts, "<u4").tobytes()
            records.append(offset)
            offset += len(record) + 1
            total_docs += len(ids)
            ids, counts = [], []
            yield record

    for group, values, sizes in documents:
        pending.append(values)
        held += len(values)
        ids += group
        counts += sizes.tolist()
        if held >= 8 * BLOCK_VALUES:
            yield from flush(False)
    yield from flush(True)
    if total_docs:
        foot = _FOOT.pack(b"PFE1", part, written, total_docs, len(starts), len(records))
        foot += np.array(starts, "<u8").tobytes() + np.array(records, "<u8").tobytes()
        yield foot + _TAIL.pack(len(foot), b"PFE1")


class TokenFile:
    """A file's bytes behind its footer: any tokens, or all documents in order."""

    def __init__(self, content: bytes):
        self.view = memoryview(content)
        at = _footer_at(content)
        _, self.part, self.n_tokens, self.n_documents, n_blocks, n_records = _FOOT.unpack_from(content, at)
        at += _FOOT.size
        self.blocks = np.frombuffer(content, "<u8", 2 * n_blocks, at).reshape(-1, 2)
        self.records = np.frombuffer(content, "<u8", n_records, at + 16 * n_blocks)
        self.held = (-1, np.zeros(0, np.uint32))

    def _block(self, i: int) -> np.ndarray:
        if self.held[0] != i:
            self.held = i, unpack_block(self.view, int(self.blocks[i, 0]))[0]
        return self.held[1]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` tokens from ``start`` on; only the blocks that hold them are unpacked."""
        parts = []
        i = int(np.searchsorted(self.blocks[:, 1], start, "right")) - 1
        while n > 0:
            inside = start - int(self.blocks[i, 1])
            some = self._block(i)[inside : inside + n]
            parts.append(some)
            start, n, i = start + len(some), n - len(some), i + 1
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint32), *parts])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of every document."""
        start = 0
        for at in self.records.tolist():
            n = _DOCS.unpack_from(self.view, at)[1]
            at += _DOCS.size
            null = np.frombuffer(self.view, np.uint8, n, at)
            keys = np.frombuffer(self.view, "<i8", n, at + n)
            counts = np.frombuffer(self.view, "<u4", n, at + 9 * n)
            for z, k, c in zip(null.tolist(), keys.tolist(), counts.tolist()):
                yield None if z else k, self.tokens(start, c)
                start += c


_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalpha())
#: Latin-1 letters, then at most one digit or a run of ASCII marks: two words to the tokenizer.
_PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+([0-9]|[!-/:-@\\[-`{-~]+)?$"
#: What the letters of ``_PLAIN`` are in lower case.
_LETTERS = "".join(c for c in map(chr, range(97, 256)) if c.isalpha() and c not in "\u00aa\u00b5\u00ba")


class LibraryEncoder:
    """The tokenizers library behind a memo of words.

    Texts are cut at white space, which no token crosses, and at the marks that
    end a chunk of letters.  Arrow does that and numbers the distinct pieces;
    each new piece goes through the library once per worker while it is
    remembered, and numpy gathers the pieces' ids in the texts' order.  The
    memo has two generations, so pieces in use survive a turn-over.
    """

    #: Pieces of a generation, but for those of one slice.
    LIMIT = 150_000
    #: Longer pieces are not remembered.
    LONGEST = 64

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, pieces: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)

    def _spell(self, pieces: list[str], letters: bool) -> list[bytes]:
        """Packed ids of each of these distinct pieces; ``letters``: each is one word to the tokenizer."""
        if len(self.known) > self.LIMIT:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = list(map(known.get, pieces))
        missed = [i for i, v in enumerate(out) if v is None]
        if not missed:
            return out
        new = []
        for i in missed:
            out[i] = older.get(pieces[i])
            if out[i] is None:
                new.append(i)
        words_of = [pieces[i] for i in new]
        if letters and new:  # one text for all: each word's ids end with a word-end label
            ids = np.array(self._library([" ".join(words_of)])[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(new):
                raise ValueError("the tokenizer file cuts words of letters")
            raw, cuts = ids.tobytes(), [0, *(4 * stops).tolist()]
            for i, x, y in zip(new, cuts, cuts[1:]):
                out[i] = raw[x:y]
        elif new:
            for i, e in zip(new, self._library(words_of)):
                out[i] = np.array(e.ids, "<u4").tobytes()
        known.update((pieces[i], out[i]) for i in missed if len(pieces[i]) <= self.LONGEST)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        flat, bounds = words.split(texts)
        coded = flat.dictionary_encode()
        chunks = coded.dictionary
        plain = pc.match_substring_regex(chunks, _PLAIN)
        low = pc.utf8_lower(chunks.filter(plain))
        body = pc.utf8_rtrim(low, _MARKS)
        bodies = body.dictionary_encode()
        tails = pc.utf8_ltrim(low, _LETTERS).dictionary_encode()
        marks, other = tails.dictionary.to_pylist(), chunks.filter(pc.invert(plain)).to_pylist()
        spelled = self._spell(bodies.dictionary.to_pylist(), True) + self._spell(marks, False) + self._spell(other, False)

        # Each distinct chunk as one or two pieces (-1: none; an empty tail is a piece without ids).
        is_plain = plain.to_numpy(zero_copy_only=False)
        n_words, n_marks = len(bodies.dictionary), len(marks)
        pieces = np.full((len(chunks), 2), -1)
        pieces[is_plain, 0] = bodies.indices.to_numpy()
        pieces[~is_plain, 0] = n_words + n_marks + np.arange(len(other))
        pieces[is_plain, 1] = n_words + tails.indices.to_numpy()

        in_order = pieces[coded.indices.to_numpy()]
        real = in_order >= 0
        at = in_order[real]
        bounds = np.concatenate([[0], np.cumsum(real.sum(1))])[bounds]
        size = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        each = size[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat((np.cumsum(size) - size)[at] - ends[:-1], each) + np.arange(ends[-1])
        return np.frombuffer(b"".join(spelled), "<u4")[place], np.diff(ends[bounds])


@functools.lru_cache(maxsize=2)
def library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the token files of ``docs`` to the folder ``out``, in ascending ``doc_id`` order."""
    ship_code(docs.sparkSession)

    def records(batches):
        def documents():
            encoder = library(tokenizer)
            for batch in batches:
                for some in words.slices(batch, 1, SLICE_BYTES):
                    ids, sizes = encoder.encode(some.column(1))
                    yield some.column(0).to_pylist(), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1

        for record in write_records(TaskContext.get().partitionId(), documents()):
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), F.xxhash64("text").alias("tie"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    ordered = ordered.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = ordered.select("doc_id", "text").mapInArrow(records, "record binary")
    # Spark's text writer puts out a string's bytes as they are, then the record's line feed.
    blocks.select(F.col("record").cast("string").alias("record")).write.option("lineSep", "\n").text(out)


def read(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document in the files of ``folder``."""
    ship_code(spark)
    rows = _documents(spark, folder, "doc_id long, part int, local long, n_tokens long, ids binary", lambda v: v.tobytes())
    return _global_starts(rows)


def digest(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``folder``."""
    ship_code(spark)
    rows = _documents(spark, folder, "doc_id long, part int, local long, n_tokens long, ids_crc32 long",
                      lambda v: zlib.crc32(np.ascontiguousarray(v)))
    return _global_starts(materialize(rows, "token-digest"))


def _documents(spark, folder: str, schema: str, last) -> DataFrame:
    names = re.findall(r"(\w+) \w+", schema)
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[k] for k in re.findall(r"\w+ (\w+)", schema)]

    def batches_of(batches):
        for batch in batches:
            for content in batch.column(0):
                content = content.as_py()
                if not content:
                    continue
                file = TokenFile(content)
                rows: list[tuple] = []
                local = size = 0
                for doc_id, values in file.documents():
                    rows.append((doc_id, file.part, local, len(values), last(values)))
                    local += len(values)
                    size += len(values)
                    if size > 4_000_000:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, types)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(batches_of, schema)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _global_starts(rows: DataFrame) -> DataFrame:
    """Add the tokens of all earlier files; one number a file is summed up."""
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = materialize(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "token-bases")
    rest = [c for c in rows.columns if c not in ("doc_id", "part", "local")]
    return rows.join(broadcast_if_small(base), "part").select(
        "doc_id", (F.col("local") + F.col("base")).alias("start"), *rest)
