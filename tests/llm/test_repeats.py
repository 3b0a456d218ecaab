"""Suffix arrays against sorting, removals against counting every window."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import common, queries, repeats, suffix

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("least", [1, 4, 256])
def test_suffix_arrays(monkeypatch, least):
    monkeypatch.setattr(suffix, "LEAST_BATCH", least)
    rng = random.Random(least)
    for _ in range(150):
        n, k = rng.randint(0, 200), rng.choice([1, 2, 3, 200])
        t = [rng.randint(1, k) for _ in range(n)]
        if rng.random() < 0.4 and n > 20:
            t = (t[: rng.randint(1, 20)] * 60)[:n]
        t = [*t, 0]
        sa = suffix.suffix_array(np.array(t, np.uint8))
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        previous, common = suffix.permuted_common_prefixes(np.array(t, np.uint8), sa, np.zeros(0, int), 1200)
        for p, q in enumerate(previous.tolist()):
            if q >= 0:
                same = next((i for i, (a, b) in enumerate(zip(t[p:], t[q:])) if a != b), min(len(t) - p, len(t) - q))
                assert common[p] == same


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, left))
    return out


def check(spark, texts, length):
    df = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "doc_id long, text string, kept string").repartition(3)
    out = repeats.remove(df, length)
    assert out.columns == ["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans", "spans", "kept_"]
    got = {r.doc_id: r for r in out.collect()}
    for i, want in enumerate(brute(texts, length)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_)) == want, (i, r.spans)
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and r.text == texts[i]


def corpus(seed, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(500)]

    def prose(k):
        return " ".join(rng.choices(words, k=k))

    passages = [prose(rng.randint(5, 60)) for _ in range(4)]
    texts = [prose(60)] * 3
    for _ in range(n):
        text = prose(rng.randint(1, 90))
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(text))
            text = text[:at] + p + text[at:]
        texts.append(text)
        if rng.random() < 0.3:  # a near copy
            at = rng.randint(0, len(text))
            texts.append(text[:at] + rng.choice(["", "x", "é"]) + text[at + 1 :])
    return texts


ODD = [None, "", "x", "x" * 500, "ab" * 300, "abc" * 20, "\x00" * 90, "é" * 60, "\U0001f600" * 30, "x" * 40, "y" * 39, "y" * 40, "z" * 41]


@pytest.mark.parametrize("length", [32, 40, 70])
def test_removals(spark, length):
    check(spark, corpus(length) + ODD, length)


def test_crowded_anchors(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(repeats, "WIDTHS", (7, 3, 1))
    monkeypatch.setattr(repeats, "STRETCH", 300)
    check(spark, corpus(9, 60) + ODD, 40)


def line_and_copies(n):
    """Texts that share a line only, and near copies of one text, each edited at one place."""
    rng = random.Random(n)

    def prose(k):
        return "".join(rng.choices("abcdef ghi", k=k))

    line, whole = prose(200), prose(900)
    texts = [prose(300) + line + prose(300) for _ in range(n)]
    for _ in range(n):
        at = rng.randrange(len(whole))
        texts.append(whole[:at] + prose(rng.randint(0, 9)) + whole[at:])
    return texts


@pytest.mark.parametrize("n", [30, 60])
def test_crowds_make_few_pieces(spark, monkeypatch, n):
    """A crowd's regions are cut into a few pieces each, however large it is, and the results are whole."""
    monkeypatch.setattr(repeats, "CROWD", 10)
    made, crowded = [], []

    def counting(df, name):
        out = stage(df, name)
        if name == "pieces":
            made.append(out.frame.count())
        if name == "known":
            crowded.append(out.frame.where("kinds > 1 and crowd").count())
        return out

    stage = repeats.stage
    monkeypatch.setattr(repeats, "stage", counting)
    check(spark, line_and_copies(n), 400)
    assert crowded[0] >= n and made[0] <= 2 * crowded[0] and sum(made) <= 6 * crowded[0]


def test_texts_are_read_once_for_all_widths(spark, monkeypatch):
    """Texts travel for the shards and for the crowds, once each, however often the crowds' regions are cut."""
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(repeats, "WIDTHS", (12, 6, 3, 1))
    made, with_texts = [], repeats._with_texts

    def counting(*args):
        made.append(args)
        return with_texts(*args)

    monkeypatch.setattr(repeats, "_with_texts", counting)
    check(spark, corpus(11, 60) + ODD, 40)
    assert len(made) == 2


def test_handed_on_in_small_batches(spark, monkeypatch):
    """Batches cut anywhere: within a text's regions, and within a region's pieces."""
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(repeats, "WIDTHS", (7, 3, 1))
    monkeypatch.setattr(repeats, "OUT_BYTES", 150, raising=False)
    monkeypatch.setattr(repeats, "OUT_ROWS", 5, raising=False)
    check(spark, corpus(12, 40) + ODD * 2, 40)


def test_full_filter(spark, monkeypatch):
    """A filter that lets many other texts through: they lose nothing."""
    monkeypatch.setattr(common, "FILTER_BITS", 128)
    texts = corpus(13, 20) + ["".join(random.Random(i).choices("abcdef", k=90)) for i in range(200)] + ODD
    check(spark, texts, 40)
    check(spark, texts[:3], 400)


def test_rows_by_a_filter_of_their_hashes(spark):
    """Every row is on one side, and wanted ones on the first; keys at both ends of their range."""
    keys = [*range(-70, 70), -(1 << 63), (1 << 63) - 1, 1 << 23, -(1 << 23) - 1]
    df = spark.createDataFrame([(k, str(k)) for k in keys * 2], "words long, text string")
    wanted = spark.createDataFrame([(k,) for k in keys[::3]], "words long")
    chosen = common.marked_by(df, wanted, "words")
    inside = sorted(r.words for r in chosen(True).collect())
    rest = sorted(r.words for r in chosen(False).collect())
    same = {k % common.FILTER_BITS for k in keys[::3]}
    assert inside == sorted(k for k in keys * 2 if k % common.FILTER_BITS in same)
    assert sorted(inside + rest) == sorted(keys * 2)
    assert "Python" not in chosen(True)._jdf.queryExecution().toString() and "Arrow" not in chosen(True)._jdf.queryExecution().toString()


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 500)
    check(spark, corpus(10), 50)


@pytest.mark.parametrize("length", [800, 1500])
def test_long_strings(spark, length):
    """Texts that share more than twice the length, in part; and a share just long enough and just too short."""
    rng = random.Random(length)

    def prose(k):
        return "".join(rng.choices("abcdef ghi", k=k))

    shared, exact, short = prose(2 * length + 700), prose(length), prose(length - 1)
    texts = [
        prose(300) + shared + prose(200), shared[100:] + prose(50), prose(10) + shared[: length + 300],
        exact + prose(100), prose(90) + exact, short + "x" + prose(40), prose(30) + "y" + short,
    ]
    check(spark, texts, length)


def test_passages_of_over_50_words(spark):
    """Passages that two texts share go by n_removed if they have 400 bytes, however many words they have; n_bytes tells nothing."""
    rng = random.Random(50)

    def prose(words, low, high):
        return " ".join("".join(rng.choices("abcdefghi", k=rng.randint(low, high))) for _ in range(words))

    long = [prose(51 + i, 8, 9) for i in range(6)]
    short = [prose(51 + i, 2, 7) for i in range(6)]
    assert min(map(len, long)) >= 400 and max(map(len, short)) < 398
    passages = [*long, *short, *[""] * 6]
    texts = [f"{prose(30, 2, 9)}{mark} {p} {mark}{prose(30, 2, 9)}" for mark in "XY" for p in passages]
    check(spark, texts, 400)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove(df, 400, keep=["doc_id"], digest=True).collect()}
    for i, text in enumerate(texts):
        p = passages[i % len(passages)]
        assert got[i].n_bytes == len(text)
        # The blanks beside a passage are shared as well.
        assert got[i].n_removed == (len(p) + 2 if p in long else 0)


def test_nothing_repeated_and_empty_table(spark):
    check(spark, ["one text " * 3, None, "another"], 40)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove(df).collect() == []


def test_documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op5_repeats(spark, SF).collect()}
    for r, (n, removed, spans, left) in zip(docs, brute([r.text for r in docs], 400), strict=True):
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_removed, g.n_spans) == (n, removed, spans)
        assert g.kept_sha256 == hashlib.sha256(left).hexdigest()
    assert sum(g.n_removed for g in got.values()) > 0
