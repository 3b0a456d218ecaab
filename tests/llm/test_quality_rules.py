"""Statistics against plain loops, the forest on planted outliers and on labelled documents."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import quality_rules as rules
from tidemark.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)]


ODD = [
    None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a", "x\n\nx\n x\nx", "\x1f \x85 \xa0   é日本 |<>#",
    "w " * 3000, "line one\r\nline one\r\nline one", "y" * 200_000, "a b a b a b", "\U0001f600 " * 60,
]


def test_statistics_agree_with_loops():
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(["a ", "b ", "c", "\n", "é ", "|", " ", "ab\n"]) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    for text in texts:
        assert rules.statistics(text)[0] == brute(text), text


def test_forest_cuts_off_values_beyond_all_good_rows():
    rng = np.random.default_rng(0)
    good = np.abs(rng.normal(size=(500, rules.N_SHARES))) * 0.1
    bad = good[:60].copy()
    bad[:, 3] += 2
    x, y = np.vstack([good, bad]), np.array([True] * 500 + [False] * 60)
    forest = rules.fit(x, y)
    rejected = forest.score(x) >= forest.threshold
    assert rejected[500:].mean() > 0.95 and rejected[:500].mean() <= rules.FALSE_ALARMS


def test_one_kind_of_label_leaves_the_base_rules():
    forest = rules.fit(np.zeros((0, rules.N_SHARES)), np.zeros(0, bool))
    assert forest.score(np.zeros((3, rules.N_SHARES))).tolist() == [0, 0, 0] and forest.threshold > 1


def test_tables_with_nulls_repeats_and_clashing_names(spark):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, "a b", 1), (3, "a b", 1), (3, "a b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label_ int")
    labels = spark.createDataFrame([(1, 0), (None, 1), (3, None), (5, 1), (9, 1)], "doc_id long, quality int")
    out = rules.judge(docs, rules.train(docs, labels))
    assert out.columns == ["doc_id", "text", "label_", *rules.BASE, "base_failed", "kept", "anomaly"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert [r[c] for c in rules.BASE] == brute(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    empty = docs.limit(0)
    assert rules.judge(empty, rules.train(empty, labels)).collect() == []


def test_labelled_documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    got = {r.doc_id: r for r in queries.op4_quality_rules(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect():
        assert [got[r.doc_id][c] for c in rules.BASE] == brute(r.text)
    labelled = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    good = [g.kept for g, q in labelled if q and not g.base_failed]
    bad = [g.kept for g, q in labelled if not q]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.1
