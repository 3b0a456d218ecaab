"""Spelling variants against plain Python."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import queries, spelling

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(docs, slips=199, length=6, least=5):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= length:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def brute(words, times=5):
    by = defaultdict(set)
    for w in words:
        for shorter in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by[shorter].add(w)
    near = defaultdict(set)
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= times * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(
        ((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=str
    )


def found(spark, words, times=5):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    return sorted((tuple(r) for r in spelling.variants(df, times).collect()), key=str)


def test_words(spark):
    docs = [
        (1, "Éclair éclair ECLAIR ÀÉÎÕÜ× naïveté"), (None, "abcdefg abcdefg"), (3, None), (4, ""), (5, "\U0001f600abcdefāghijkl"),
        (5, "abcdefg " * 40000), (5, "abcdefg"), (7, "x" * 5000), (8, "!!!"),
    ]
    rng = random.Random(2)
    docs += [(i, " ".join("".join(rng.choices("abé", k=7)) for _ in range(60))) for i in range(100, 160)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n")
    for slips, length, least in ((199, 6, 1), (3, 6, 2), (None, 1, 1)):
        got = {r.word: r.n for r in spelling.words(df, length, least, slips).collect()}
        assert got == counted(docs, slips, length, least)


@pytest.mark.parametrize("alphabet, lengths", [("ab", (6, 9)), ("abcdé", (3, 6)), ("aé", (1, 5))])
def test_variants_of_dense_vocabularies(spark, alphabet, lengths):
    rng = random.Random(7)
    words = {"".join(rng.choices(alphabet, k=rng.randint(*lengths))): rng.choice([5, 6, 30, 31, 200, 1000]) for _ in range(250)}
    assert found(spark, words) == brute(words)


def test_runs_of_one_letter_and_long_words(spark):
    words = {"a" * k: 10**k for k in range(1, 9)}
    words |= {"b" * 3000: 50, "b" * 3001: 9, "b" * 1500 + "c" + "b" * 1500: 7, "b" * 2999 + "d": 6}
    assert found(spark, words) == brute(words)


def test_chain_of_forms(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzz": 8}
    got = found(spark, words)
    assert got == brute(words)
    assert {r[2] for r in got} == {"abbbbb", "zzzzzz"}


def test_ties_one_word_and_none(spark):
    words = {"kitten": 5, "mitten": 100, "bitten": 100, "kitte": 100}
    assert found(spark, words) == brute(words)
    assert found(spark, {"single": 9}) == [("single", None, "single", 9, 0, None)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.words(empty)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_spelling"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(counted(docs))
