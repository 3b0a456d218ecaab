"""Ranked search against a plain loop over all documents."""

import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score), each item for itself."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // length
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(7 * i, " ".join(rng.choices(words, weights, k=rng.randint(1, 120)))) for i in range(n)]


ODD = [
    (None, "w1 w2 no id"), (None, None), (1, ""), (2, None), (3, "!!! ???"), (4, "É\U0001f600é w3"), (5, "W1 W2 w2"),
    (6, "same w9"), (6, "same w9"), (6, "w7 other"), (10**9, "x y w1 " * 30000),
]

ITEMS = [
    (1, "w1 w2 w3 w300"), (1, "w390 w391 w1 w1 w1"), (None, "w5 W7, w9"), (3, None), (4, ""), (5, "nowhere found"),
    (6, "É\U0001f600é"), (7, " ".join(f"w{i}" for i in range(400))), (8, "w0"),
]


def found(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked_search.search(d, i, k).collect()), key=str)


@pytest.mark.parametrize("k", [1, 5, 20])
def test_equal_to_brute_force(spark, k):
    docs = corpus(300) + ODD
    assert found(spark, docs, ITEMS, k) == brute(docs, ITEMS, k)


def test_small_lists_and_blocks_give_the_same(spark, monkeypatch):
    docs = corpus(200, 2) + ODD
    monkeypatch.setattr(ranked_search, "POSTINGS", 500)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 6)
    assert found(spark, docs, ITEMS) == brute(docs, ITEMS)


def test_ties_go_by_id(spark):
    docs = [(i, "same text here") for i in range(60)] + [(100 + i, f"rare{i} words") for i in range(60)]
    got = found(spark, docs, [(1, "same text")])
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(20))


def test_accumulators_are_limited(spark):
    """With a rare and a common term, documents that hold only the common one get no accumulator."""
    import numpy as np

    class Known:
        documents, length = 1000, 3000
        weights = np.array([6000, 10], np.int64)

        def measure(self, n):
            return 75 + 25 * n * self.documents // self.length

    n = np.full(1000, 3, np.int64)
    held = np.array([x for i in range(1000) for x in ([0, 1] if i < 30 else [1])], np.int32)
    ends = np.append(0, np.cumsum([2 if i < 30 else 1 for i in range(1000)]))
    lists = ranked_search.Lists(n, ends, held, np.ones(len(held), np.int32), Known())
    score = np.zeros(1000, np.int64)
    touched = []
    lists_of, lists.of = lists.of, lambda t: touched.append((t, np.count_nonzero(score))) or lists_of(t)
    docs, scores = ranked_search.best(lists, [(0, 1), (1, 1)], 20, 0, score)
    assert touched == [(0, 0), (1, 30)] and len(docs) == 30 and not score.any()
    assert set(scores) == {int(lists.gain[0] + lists.gain[-1])}


def test_large_numbers_stay_exact():
    import numpy as np

    corpus = ranked_search.Corpus.__new__(ranked_search.Corpus)
    corpus.documents, corpus.length = 10**13, 7 * 10**14
    n = np.array([1, 10**7], np.int64)
    assert list(corpus.measure(n)) == [75 + 25 * int(x) * 10**13 // (7 * 10**14) for x in n]


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame(corpus(30), "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    assert ranked_search.search(docs.limit(0), items).collect() == []
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    wide = docs.selectExpr("*", "1 as rank", "2 as score", "'x' as item_id", "3 as n", "4 as part")
    more = items.selectExpr("*", "1 as rank", "9 as doc_id", "0 as item")
    assert sorted(ranked_search.search(wide, more).collect()) == sorted(ranked_search.search(docs, items).collect())
