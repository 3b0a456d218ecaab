"""Components against all pairs."""

import os
import random
import re

import numpy as np
import pytest

from tidemark.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, percent=90):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * (s := len(a & b)) >= percent * (len(a) + len(b) - s):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(
        (str(doc), len(sets[i]), str(least.get(find(i)) if sets[i] else doc)) for i, (doc, _) in enumerate(rows)
    )


def found(spark, rows, percent=90):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.join(df, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out.collect())


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


def corpus(seed, groups, copies, length, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=length)
        for _ in range(copies):
            words = edited(rng, base, rng.randint(0, edits), vocabulary)
            at = rng.randrange(len(words))
            text = " ".join(words[:at] + passage + words[at:] if rng.random() < 0.2 else words)
            rows.append(text.upper() if rng.random() < 0.1 else text)
    rng.shuffle(rows)
    return list(enumerate(rows))


ODD = [
    (1000, ""), (1001, None), (1002, " \t\n"), (1003, "one"), (1004, "ONE "), (1005, "one two"), (1006, "one\ntwo"),
    (None, "one two"), (1007, "one two three"), (1008, "É a b"), (1009, "é a b"), (1010, "a\xa0b c d"), (1005, "one two"),
    (1011, "x " * 30000), (1012, "x " * 20000), (None, "alone in the corpus"), (None, None), (1013, "İ i I"),
]


def test_small_groups_and_odd_rows(spark):
    rows = corpus(1, 30, 5, 90, 4) + ODD
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("percent", [60, 100])
def test_other_thresholds(spark, percent):
    rows = corpus(2, 10, 5, 60, 6)
    assert found(spark, rows, percent) == brute(rows, percent)


@pytest.mark.parametrize("edits", [2, 9])
def test_hot_columns(spark, monkeypatch, edits):
    monkeypatch.setattr(ngram_join, "HOT", 10)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 12_000)
    rows = corpus(3, 2, 60, 100, edits) + corpus(4, 10, 3, 80, 3)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert found(spark, rows) == brute(rows)


def test_hot_columns_in_one_tile(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 10)
    rows = [(i, t) for i, (_, t) in enumerate(corpus(5, 3, 40, 100, 6) + corpus(6, 10, 3, 80, 3))]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("two", [False, True])
def test_tiles_by_ranges_and_blocks(monkeypatch, two):
    monkeypatch.setattr(ngram_join, "RANGE_WEIGHT", 300)
    monkeypatch.setattr(ngram_join, "BLOCK_CELLS", 200)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(11)
    values = np.sort(rng.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64, endpoint=False))
    values[0], values[-1] = -(1 << 63), (1 << 63) - 1
    sets = [np.sort(rng.choice(values, rng.integers(1, 60), replace=False)) for _ in range(50)]
    x, y = (sets[:20], sets[20:]) if two else (sets, None)
    other = sets[20:] if two else sets
    overlaps = [[len(np.intersect1d(a, b)) for b in other] for a in x]
    assert ngram_join._tile(x, y).tolist() == overlaps

    names = np.arange(50)
    found = ngram_join._edges(names[: len(x)], x, names[20:] if two else None, y, 60)
    root = {int(n): int(n) for n in names}

    def joined(edges):
        group = dict(root)
        for a, b in edges:
            low, high = sorted((group[a], group[b]))
            group = {n: low if g == high else g for n, g in group.items()}
        return group

    links = [
        (i, j + 20 * two) for i, row in enumerate(overlaps) for j, s in enumerate(row)
        if 100 * s >= 60 * (len(x[i]) + len(other[j]) - s)
    ]
    assert joined(zip(found.a, found.b)) == joined(links)


def test_words_of_long_texts_are_hashed_alike(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("ab Ã\n\tZ") for _ in range(4000)) + " " + "w" * 3000 + " b"
    whole = ngram_join.Grams(3)(text)
    monkeypatch.setattr(ngram_join, "STRETCH", 100)
    assert ngram_join.Grams(3)(text).tolist() == whole.tolist()
    assert len(whole) == len(grams(text))


def test_empty_table(spark):
    assert found(spark, []) == []


def test_documents(spark):
    sf = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(sf).select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)
