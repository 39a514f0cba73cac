"""BPE encoding and decoding with a compiled tokenization automaton.

Compilation applies one *merge gadget* per merge, in rank order, to a
deterministic automaton over tokens that starts as one state looping on the
base symbols.  The gadget of merge ``k: (u, v) -> w``

* copies the state that arc ``u`` leads to, without its arc ``v``, and leads
  ``u`` to the copy (after ``u`` the pair would have been merged), and
* adds an arc ``w`` wherever there is an arc ``u``, into the state that ``v``
  led to.

All arcs with one label lead to one state, so a state is named by the label
that enters it.  After the last gadget the automaton accepts exactly one
segmentation of each word, its BPE tokenization, and every prefix of that
segmentation is the tokenization of the prefix.  Encoding follows arcs of the
transition table left to right; each position has one possible state, so a
dead end is left for good.

Copies share structure: a state holds its lineage, (label, time) pairs that
say "all cuts made after this label before this time"; an arc holds the spine
of labels it grew from.  An arc is absent iff a cut hits both.  The table is
filled from these on first use and kept.

Defined results: a null text encodes as an empty one; an empty text has no
token and decodes to an empty text; very long texts are encoded whole; repeated
rows give repeated results.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from array import array

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.llm.common import WordCache, ship_code

# White space and pre-split pattern of the tokenizer files.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_WS}\p{{L}}\p{{N}}]+"
_NEVER = 1 << 60
#: Chunks that a generation of an encoder's memo holds; half as many words, twice as many arcs.
MEMO = 100_000


_BLANK = regex.compile(f"[{_WS}]+")


def split(text: str) -> list[str]:
    """Blank-separated chunks; no token crosses a blank."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # blanks to str.split, not to the tokenizer
        return [c for c in _BLANK.split(text) if c]
    return text.split()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


def _is_open(lineage, spine, cuts: dict[int, dict[int, int]]) -> bool:
    """Whether no cut hits both a state's lineage and an arc's spine."""
    for label, until in lineage:
        cut = cuts.get(label)
        if cut:
            for t, hidden in spine:
                k = cut.get(t)
                if k is not None and k < until and k <= hidden:
                    return False
    return True


class _Pairs:
    """The (label, time) pairs of every label as flat arrays: a tenth of the memory of tuples."""

    def __init__(self, pairs: dict[int, tuple], width: int):
        self.starts, self.labels, self.times = array("I", [0]), array("I"), array("Q")
        for i in range(width):
            for label, at in pairs.get(i, ()):
                self.labels.append(label)
                self.times.append(at)
            self.starts.append(len(self.labels))

    def __contains__(self, label: int) -> bool:
        return self.starts[label] < self.starts[label + 1]

    def __getitem__(self, label: int) -> list[tuple[int, int]]:
        x, y = self.starts[label], self.starts[label + 1]
        return list(zip(self.labels[x:y], self.times[x:y]))


class Automaton:
    """Deterministic token automaton of a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], most: int = 2 * MEMO):
        self.labels = {i: t for t, i in vocab.items()}
        self.width = max(vocab.values()) + 1
        grown: dict[int, tuple] = {}  # arc -> spine of (label, hidden from this time on)
        lineage: dict[int, tuple] = {}  # state -> (label, cuts before this time)
        cuts: dict[int, dict[int, int]] = {}  # label -> {arc cut after it: time}
        made = {a + b for a, b in merges}
        for t, i in vocab.items():
            if t not in made:
                grown[i] = lineage[i] = ((i, _NEVER),)
        self.cuts, self.table, self.most = cuts, {}, most
        for k, (a, b) in enumerate(merges, 1):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if w in grown:
                raise ValueError(f"two merges make {a + b!r}")
            if u not in grown or v not in grown or not _is_open(lineage[u], grown[v], cuts):
                continue  # no path uses this pair any more: the label is unreachable
            # w's state is the one v led to so far; its spine is u's so far.
            lineage[w] = ((w, _NEVER), *(pair if pair[1] <= k else (pair[0], k) for pair in lineage[v]))
            grown[w] = ((w, _NEVER), *(pair if pair[1] <= k else (pair[0], k) for pair in grown[u]))
            cuts.setdefault(u, {})[v] = k
        self.grown, self.lineage = _Pairs(grown, self.width), _Pairs(lineage, self.width)
        self.step: dict[int, int] = {}
        self.token_at = [-1]

    def _arc(self, state: int, token: int) -> bool:
        """Whether ``token`` leaves ``state``: no cut hits both its lineage and its spine."""
        return _is_open(self.lineage[state], self.grown[token], self.cuts)

    def arc(self, state: int, token: int) -> bool:
        key = state * self.width + token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > self.most:
                self.table.clear()
            known = self.table[key] = self._arc(state, token)
        return known

    def add_spelling(self, token: int, symbols: list[int]) -> None:
        """Enter a label's spelling into the table of symbol steps."""
        node = 0
        for s in symbols:
            node = self.step.setdefault(node << 9 | s, len(self.token_at))
            if node == len(self.token_at):
                self.token_at.append(-1)
        self.token_at[node] = token

    def run(self, symbols: list[int]) -> list[int]:
        """The accepted path over ``symbols``, as arc labels.

        Depth first, longest label first.  A prefix has one accepted path, so
        a position that once led nowhere is never entered again.
        """
        n = len(symbols)
        step, token_at, width, table = self.step.get, self.token_at, self.width, self.table
        path: list[int] = []
        left: list[tuple[int, list]] = []  # position and untried arcs before each label of the path
        dead: set[int] = set()
        at, state, arcs = 0, -1, None
        while at < n:
            if arcs is None:
                arcs, node = [], 0
                for j in range(at, n):
                    node = step(node << 9 | symbols[j])
                    if node is None:
                        break
                    t = token_at[node]
                    if t >= 0:
                        arcs.append((j + 1, t))
            while arcs:
                end, t = arcs.pop()
                if end in dead:
                    continue
                if state >= 0:
                    allowed = table.get(state * width + t)
                    if not (self.arc(state, t) if allowed is None else allowed):
                        continue
                left.append((at, arcs))
                path.append(t)
                at, state, arcs = end, t, None
                break
            else:
                dead.add(at)
                at, arcs = left.pop()
                path.pop()
                state = path[-1] if path else -1
        return path


class WordBpe:
    """Encoder and decoder of one tokenizer file of the word-end kind."""

    def __init__(self, path: str, memo: int = MEMO):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = a = Automaton(vocab, merges, 2 * memo)
        self.byte_of = byte_of = {c: b for b, c in enumerate(byte_symbols())}
        for t, i in vocab.items():
            if i in a.grown:  # reachable
                body = t[: -len(end)] if t.endswith(end) else t
                symbols = [byte_of[c] for c in body]
                if t.endswith(end):
                    symbols[-1] += 256
                a.add_spelling(i, symbols)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = a.labels | {i: t for t, i in added.items()}
        self.labels = [names.get(i, "") for i in range(max(names) + 1)]
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.added = added
        self.pattern = regex.compile(_WORD_PATTERN)
        self.words = WordCache(self._word, memo // 2)
        self.chunks = WordCache(self._chunk, memo)

    def _word(self, word: str) -> bytes:
        symbols = list(word.encode("utf-8", "surrogatepass"))
        symbols[-1] += 256
        return array("I", self.automaton.run(symbols)).tobytes()

    @functools.cached_property
    def _file(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return self.words[text]
            if text[:-1].isalpha():  # letters and one mark or digit: two words
                return self.words[text[:-1]] + self.words[text[-1]]
            return b"".join([self.words[w] for w in self.pattern.findall(text)])
        if any(unicodedata.category(c) == "Cn" for c in text):
            # Newer characters than Python's tables know: let the file's own rules split.
            parts = self._file.pre_tokenizer.pre_tokenize_str(self._file.normalizer.normalize_str(text))
            return b"".join(self._word(bytes(self.byte_of[c] for c in w).decode()) for w, _ in parts)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return b"".join([self.words[w] for w in self.pattern.findall(text)])

    def _chunk(self, chunk: str) -> bytes:
        if self.special is None or "<|" not in chunk:
            return self._plain(chunk)
        out, at = [], 0
        for m in self.special.finditer(chunk):
            out += [self._plain(chunk[at : m.start()]), array("I", [self.added[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(chunk[at:])])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        chunks = self.chunks
        return b"".join([chunks[c] for c in split(text)])

    def decode(self, ids: bytes) -> str:
        """The arc labels of ``ids``, space-joined (the files name no decoder)."""
        return " ".join(map(self.labels.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def load(path: str, memo: int = MEMO) -> WordBpe:
    return WordBpe(path, memo)



def _by_slices(texts: pa.Array, make, rows: int = 500) -> pa.Array:
    """``make`` over slices of a batch, so that few texts are Python objects at a time."""
    parts = [make(texts.slice(i, rows).to_pylist()) for i in range(0, max(1, len(texts)), rows)]
    return pa.concat_arrays(parts)


def encode(text: Column, path: str) -> Column:
    """Ids of ``text`` as packed little-endian uint32 (binary), encoded in the workers."""

    @F.arrow_udf("binary")
    def bpe_encode(texts: pa.Array) -> pa.Array:
        bpe = load(path)
        return _by_slices(texts, lambda part: pa.array([bpe.encode(t) for t in part], pa.binary()))

    return bpe_encode(text)


def decode(ids: Column, path: str) -> Column:
    """Text of packed ids: their arc labels, space-joined."""

    @F.arrow_udf("string")
    def bpe_decode(rows: pa.Array) -> pa.Array:
        bpe = load(path)
        return _by_slices(rows, lambda part: pa.array([bpe.decode(r or b"") for r in part], pa.string()))

    return bpe_decode(ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", memo: int = MEMO) -> DataFrame:
    """(key, ids binary, n_tokens, decoded) of every row; other columns are not read.

    One function does both directions, else every text would be encoded
    twice, and puts out a slice at a time, so a worker holds few results.
    """
    ship_code(docs.sparkSession)

    def round_trip(batches):
        bpe = load(path, memo)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                ids = [bpe.encode(t) for t in some.column(1).to_pylist()]
                decoded = pa.array([bpe.decode(p) for p in ids], pa.string())
                count = pa.array([len(p) // 4 for p in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.binary()), count, decoded], ["key", "ids", "n_tokens", "decoded"])
            batch = some = ids = count = decoded = None
        pa.default_memory_pool().release_unused()  # the worker lives on

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType()),
    ])
    return rows.mapInArrow(round_trip, schema).withColumnRenamed("key", key)


def digest(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return encoded.select(
        key, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
