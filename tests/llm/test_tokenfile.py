import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelspark.llm import tokenfile as tf
from parcelspark.llm.queries import op8_tokenfile, tokenizer_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.floats(0, 1))
def test_block_round_trip(values, percentile):
    record = tf.pack_block(np.array(values, np.uint32), 0, percentile)
    got, end = tf.unpack_block(memoryview(record))
    assert got.tolist() == values and end == len(record)


def test_outliers_go_to_the_exception_list():
    values = np.full(1000, 5, np.uint32)
    values[[3, 700]] = 2**31
    record = tf.pack_block(values, 0)
    assert len(record) < 100
    assert (tf.unpack_block(memoryview(record))[0] == values).all()


def groups(docs, many=3):
    for i in range(0, len(docs), many):
        some = docs[i : i + many]
        yield [k for k, _ in some], np.concatenate([v for _, v in some]), np.array([len(v) for _, v in some])


@pytest.mark.parametrize("sizes", [[], [0], [0, 0, 5], [70_000, 1, 0, 300_000, 2], [1] * 5000])
def test_file_round_trip_and_index(sizes):
    rng = np.random.default_rng(1)
    docs = [(None if i == 1 else i - 3, rng.integers(0, 50_000, n).astype("<u4")) for i, n in enumerate(sizes)]
    content = b"".join(r + b"\n" for r in tf.write_records(7, groups(docs)))
    if not sizes:
        assert content == b""
        return
    file = tf.TokenFile(content)
    got = list(file.documents())
    assert file.part == 7 and [i for i, _ in got] == [i for i, _ in docs]
    assert all((a == b).all() and len(a) == len(b) for (_, a), (_, b) in zip(got, docs))
    flat = np.concatenate([v for _, v in docs])
    for offset, first in tf.block_starts(content):
        values, _ = tf.unpack_block(memoryview(content), offset)
        assert (values == flat[first : first + len(values)]).all()
    for start in rng.integers(0, max(1, len(flat)), 20).tolist():
        for n in (0, 1, 40_000):
            assert file.tokens(start, min(n, len(flat) - start)).tolist() == flat[start : start + n].tolist()


def test_library_encoder_equals_the_library():
    lib = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(2)
    enc = tf.LibraryEncoder(tokenizer_path())
    texts = ["", "It's a Test. x1 1x 'tis don' <|endoftext|>. É́ \x1c a", "ÉTÉ été, naïf1 ÑANDÚ. ß ÿ Ÿ ΑΣ σας İx İ, é́ Ǆ ᾳ µ ª"] + [
        "".join(rng.choice("aB é.'1 \n<|>漢") for _ in range(40)) for _ in range(500)]
    texts += [c + m for c in ("a", "É", "ªb", "İ", "µ", "x\u0301", "\u1e9e") for m in ["", *map(chr, range(33, 127)), "''", "x" * 70]]
    texts += ["Word, " * 50, "\x1cA\x1d b\x85c\xa0D.\u2003e", None, "<|startoftext|>x <|endoftext|>"]
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, sizes = enc.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == want
        enc.LIMIT = 10  # forgets between calls


def brute(rows):
    lib = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_odd_rows(spark, tmp_path):
    rows = [(None, "no id"), (-5, None), (1, ""), (2, "word " * 90_000), (7, "a b"), (9, "same"), (9, "same")]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").selectExpr("*", "1 as tie", "2 as part", "'r' as record")
    tf.write(df, str(tmp_path / "t"), tokenizer_path())
    got = [tuple(r) for r in tf.digest(spark, str(tmp_path / "t")).orderBy("start").collect()]
    assert got == brute(rows)
    full = tf.read(spark, str(tmp_path / "t")).collect()
    assert sorted((r.start, r.n_tokens, zlib.crc32(r.ids)) for r in full) == [g[1:] for g in got]
    tf.write(df.limit(0), str(tmp_path / "e"), tokenizer_path())
    assert tf.digest(spark, str(tmp_path / "e")).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert [tuple(r) for r in op8_tokenfile(spark, sf).orderBy("doc_id").collect()] == brute(rows)


def test_pieces_in_use_stay_known_and_marks_make_no_new_ones():
    enc = tf.LibraryEncoder(tokenizer_path())
    enc.LIMIT, asked, library = 3, [], enc._library
    enc._library = lambda pieces: asked.extend(pieces) or library(pieces)
    enc.encode(pa.array(["alpha beta gamma delta"]))
    asked.clear()
    enc.encode(pa.array(["alpha omega"]))  # after the turn-over
    assert asked == ["omega"]
    asked.clear()
    enc.encode(pa.array(["alpha&&& omega&&& Alpha&&&"]))
    assert asked == ["&&&"]
