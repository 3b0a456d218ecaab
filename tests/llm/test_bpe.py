"""Tokens against the tokenizers library, texts against themselves."""

import hashlib
import os
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries

SF = "/root/testdata/sf0.001"
PARTS = ["a", "b", "e", "th", " ", "  ", "\n", "é", "日本", "1", "23", "'s", "'ll", "!!", "<|endoftext|>", "\t", "the", "ing",
         "\U0001f600", "=", "====", "zz", "\x00", "İ", "​", "\xa0", "ﬀ", "<|", "|>"]
LONG = ["a" * 50_000, "==" * 30_000, "ab" * 20_000, " " * 10_000, "<|endoftext|>" * 50, "x y " * 20_000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.TOKENIZER)


@pytest.fixture(scope="module")
def codec():
    with open(queries.TOKENIZER, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def random_texts(n):
    rng = random.Random(3)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(n)]


def test_ids_and_texts_agree_with_the_library(codec, library):
    texts = random_texts(4000) + LONG
    for text, found, want in zip(texts, codec.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(found, "<u4").tolist() == want.ids, text[:80]
        assert codec.decode(found) == library.decode(want.ids, skip_special_tokens=False) == text


def test_pair_test_agrees_with_merging(codec):
    rng = np.random.default_rng(1)
    tokens = np.array(sorted(codec.proposed.values()))
    x, y = rng.choice(tokens, 3000), rng.choice(tokens, 3000)
    for a, b, good in zip(x.tolist(), y.tolist(), codec.compatible(x, y).tolist()):
        assert good == (codec.merged(codec.pieces[a] + codec.pieces[b]) == [a, b])


def test_many_words_at_once_agree_with_one_at_a_time(codec):
    rng = random.Random(8)
    words = ["".join(rng.choices(PARTS, k=rng.randint(0, 12))).encode() for _ in range(6000)] + [b"a" * 300, b"", bytes(range(256))]
    for word, ids in zip(words, codec.merge(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == codec.merged(word)
    flat, lengths = codec.match(words)
    assert np.split(flat, np.cumsum(lengths)[:-1])[0].tolist() == codec.longest_match(words[0])
    assert flat.tolist() == [t for w in words for t in codec.longest_match(w)]
    assert lengths.tolist() == [len(codec.longest_match(w)) for w in words]


def test_a_full_cache_changes_nothing(monkeypatch, codec):
    texts = random_texts(200)
    want = codec.encode(texts)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 20)
    monkeypatch.setattr(bpe, "CACHED_BYTES", 3)
    assert [codec.encode([t])[0] for t in texts] == want


def test_few_words_are_held_at_once(monkeypatch, codec):
    """However many texts a batch has, the words of a few are cut at once, and the cache stays within its bound."""
    texts = random_texts(300) + [f"{i} w{i}" for i in range(3000)]
    want, cut, held = codec.encode(texts), [], []
    learn = type(codec).learn
    monkeypatch.setattr(codec, "learn", lambda words: cut.append(sum(map(len, words))) or learn(codec, words), raising=False)
    monkeypatch.setattr(codec, "cache", {})
    monkeypatch.setattr(codec, "older", {}, raising=False)
    for name, most in (("CUT_CHARS", 2000), ("CACHED_WORDS", 400)):
        monkeypatch.setattr(bpe, name, most, raising=False)
    assert codec.encode(texts) == want
    assert max(cut) <= 2000 + max(map(len, texts))
    for i in range(0, len(texts), 10):
        assert codec.encode(texts[i : i + 10]) == want[i : i + 10]
        held.append(len(codec.cache) + len(codec.older))
    assert max(held) <= 400 + 1000


def test_decoding_broken_ids(codec, library):
    ids = [220, 447, 118, 50256]  # a cut character
    assert codec.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_tables_with_nulls_repeats_and_clashing_names(spark, library):
    rows = [(1, "a text", [7]), (1, "a text", [7]), (None, None, None), (2, "", [])] + [(i, t, []) for i, t in enumerate(LONG, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    out = bpe.encode(df, queries.TOKENIZER)
    assert out.columns == ["doc_id", "text", "ids", "ids_"] and out.count() == len(rows)
    back = bpe.decode(out, queries.TOKENIZER, ids="ids_")
    assert all(r.decoded == (r.text or "") for r in back.collect())
    empty = df.limit(0)
    assert bpe.decode(bpe.encode(empty, queries.TOKENIZER), queries.TOKENIZER, ids="ids_").collect() == []
    assert bpe.round_trip(empty, queries.TOKENIZER).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op2_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
