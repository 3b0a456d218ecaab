"""Held-out accuracy, gradients against differences, and the rows that no language has."""

import os
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import langid, queries

SF = "/root/testdata/sf0.01"
PARTS = {"aa": ["ka", "lo", "mi"], "bb": ["str", "onk", "ü"], "cc": ["sha", "quo", "è"]}


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        language = list(PARTS)[i % 3]
        words = ["".join(rng.choices(PARTS[language], k=rng.randint(1, 4))) for _ in range(rng.randint(1, 30))]
        out.append((" ".join(words), language))
    return out


def test_learns_made_up_languages():
    run = langid.fit(rows(90, 1)).predictor()
    test = rows(300, 2)
    best, score = run([t for t, _ in test])
    assert np.mean([b == want for b, (_, want) in zip(best, test)]) > 0.97
    assert all(0 <= s <= 1 for s in score)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    h, x = 3, rng.integers(97, 103, (4, 5))
    w = {k: rng.normal(0, 0.5, s) for k, s in {"Ef": (256, 9), "Uf": (3, 9)}.items()}
    target = rng.normal(size=(5, 4, h))

    def loss():
        return float((langid._run(x, w, "f")[0] * target).sum())

    _, kept = langid._run(x, w, "f", keep=True)
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    langid._back(target, kept, x, w, "f", grad)
    for name in w:
        for _ in range(6):
            at = (int(rng.choice(np.unique(x))) if name == "Ef" else int(rng.integers(3)), int(rng.integers(9)))
            old, step = w[name][at], 1e-2
            w[name][at] = old + step
            up = loss()
            w[name][at] = old - step
            down = loss()
            w[name][at] = old
            assert abs((up - down) / (2 * step) - grad[name][at]) < 2e-3 * (1 + abs(grad[name][at]))


def test_rows_without_language():
    run = langid.fit(rows(90, 1)).predictor()
    best, score = run([None, "", "123 !?", "x" * 100_000, "kalomi 7", "日本"])
    assert best[:3] == ["und"] * 3 and score[:3] == [0, 0, 0] and "und" not in best[3:]
    assert langid.fit([]).predictor()(["word"]) == [["und"], [0.0]]
    assert langid.fit([("kalo", "aa")]).predictor()(["word", "4"])[0] == ["aa", "und"]


def test_tables_with_nulls_repeats_and_clashing_names(spark):
    data = [(i, t, lang, 1) for i, (t, lang) in enumerate(rows(60, 3))] + [(None, None, None, 1), (5, "", "aa", 1), (5, "", "aa", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, text_ int")
    out = langid.identify(docs, langid.train(docs))
    assert out.columns == ["doc_id", "text", "lang", "text_", "lang_pred", "score"] and out.count() == 63
    assert langid.identify(docs.limit(0), langid.train(docs.limit(0))).collect() == []


def test_held_out_documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    got = {r.doc_id: r for r in queries.op7_langid(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = [(got[r.doc_id], r.lang) for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(g.held_out for g, _ in held) and sum(g.held_out for g in got.values()) == len(held)
    assert np.mean([g.lang_pred == lang for g, lang in held]) >= 0.97
