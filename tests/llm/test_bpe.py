import hashlib
import random
from array import array

import pytest
from tokenizers import Tokenizer

from parcelspark.llm import bpe
from parcelspark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def pair():
    return bpe.load(tokenizer_path()), Tokenizer.from_file(tokenizer_path())


def same(pair, text):
    mine, lib = pair
    ids = lib.encode(text, add_special_tokens=False).ids
    packed = mine.encode(text)
    assert list(memoryview(packed).cast("I")) == ids, ascii(text)
    assert mine.decode(packed) == lib.decode(ids, skip_special_tokens=False)


def test_every_base_symbol_and_unicode_oddities(pair):
    for text in ["", " ", "a", "It's 's 'LL", "ΑΣ ΣΑΣ", "İstanbul", "a\x1cb \x1d", "é ́",
                 "x<|endoftext|>y<|startoftext|>", "<|", "Ᲊ\U000187f8a", " a　b", "\x00�"]:
        same(pair, text)


def test_repeated_letters_and_mixed_words(pair):
    rng = random.Random(5)
    for _ in range(2000):
        same(pair, "".join(rng.choice("aab") for _ in range(rng.randint(1, 40))))
        same(pair, "".join(rng.choice("theinrsoéß漢 \n'ſ12!<|>.́") for _ in range(20)))


def test_automaton_matches_rank_order_merging():
    """Brute force: apply the lowest-ranked merge, leftmost first, until none applies."""
    rng = random.Random(3)
    vocab = {c: i for i, c in enumerate("abc")}
    merges = []
    for _ in range(30):
        a, b = rng.choice(list(vocab)), rng.choice(list(vocab))
        if a + b not in vocab and len(a + b) < 9:
            merges.append((a, b))
            vocab[a + b] = len(vocab)
    auto = bpe.Automaton(vocab, merges)
    for t, i in vocab.items():
        if i in auto.grown:
            auto.add_spelling(i, [vocab[c] for c in t])
    rank = {m: k for k, m in enumerate(merges)}
    for _ in range(3000):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 25)))
        parts = list(word)
        while True:
            k = min((rank.get(p, 10**9) for p in zip(parts, parts[1:])), default=10**9)
            if k == 10**9:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and rank.get((parts[i], parts[i + 1])) == k:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        assert [vocab[p] for p in parts] == auto.run([vocab[c] for c in word]), word


def test_query_on_odd_rows(spark, tmp_path, pair):
    lib = pair[1]
    long = "thing ofthe é! " * 20000
    rows = [(1, None), (2, ""), (3, "Hello  World"), (3, "Hello  World"), (None, "x"), (4, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as ids", "2 as n_tokens", "'q' as decoded")
    got = bpe.digest(bpe.encode_documents(df, tokenizer_path())).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t in rows}
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(
            lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digest(bpe.encode_documents(df.limit(0), tokenizer_path())).count() == 0
