"""Held-out accuracy, and the rows that no model expects."""

import random
import zlib

import pytest

from tidemark.llm import queries, toxicity

SF = "/root/testdata/sf0.01"

SYLLABLES = ["an", "re", "ti", "on", "er", "sh", "ou", "le", "mi", "ta"]


def texts(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(30, 120))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(5):
                words[rng.randrange(len(words))] = rng.choice(["vilewort", "grimhex", "foulspit"])
        rows.append((i, " ".join(words), toxic))
    return rows


def test_fit_separates_unseen_texts():
    rows = texts(600)
    run = toxicity.fit(rows[:400]).scorer()
    got = [s >= toxicity.TOXIC for s in run([t for _, t, _ in rows[400:]])]
    want = [bool(y) for *_, y in rows[400:]]
    assert sum(a != b for a, b in zip(got, want)) <= 4


def test_long_ordinary_text_stays_ordinary_and_long_toxic_text_is_seen():
    rows = texts(600)
    run = toxicity.fit(rows[:400]).scorer()
    ordinary = " ".join(t for _, t, y in rows[400:] if not y)
    toxic = " ".join(t for _, t, y in rows[400:] if y)
    got = run([ordinary * 3, toxic * 3, "", None, "!" * 1000, "x" * 300_000])
    assert got[0] < toxicity.TOXIC <= got[1] and max(got[2:]) < toxicity.TOXIC


def test_one_class_or_none_gives_the_share():
    assert toxicity.fit([]).scorer()(["a"]) == [0.0]
    assert toxicity.fit([(i, "some text", 1) for i in range(9)]).scorer()(["a", None]) == [1.0, 1.0]


def test_tables_with_nulls_repeats_and_clashing_names(spark):
    rows = [(i, t, 0.5) for i, t, _ in texts(200)] + [(None, None, None), (3, "", 0.1), (3, "", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_ double")
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in texts(200)] + [(None, 1), (7, None), (8, 0), (8, 1)], "doc_id long, toxic int"
    )
    out = toxicity.score(docs, toxicity.train(docs, labels))
    assert out.columns == ["doc_id", "text", "text_", "score"] and out.count() == 203
    assert all(0 <= r.score <= 1 for r in out.collect())
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.train(empty, labels.limit(0))).collect() == []


def test_held_out_documents(spark):
    import os

    if not os.path.isdir(SF):
        pytest.skip("no test data")
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, SF).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [r for r in labels if got[r.doc_id].held_out]
    # The few labels of this size teach English only; what toxic rows there are in other languages is tested below.
    wrong = sum(got[r.doc_id].predicted != r.toxic for r in held if docs[r.doc_id].lang == "en" or not r.toxic)
    assert wrong <= 0.05 * len(held)


def test_held_out_documents_of_every_language(spark):
    import os
    from collections import Counter

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    model = queries.toxicity_model(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1")
    scored = toxicity.score(docs.join(labels, "doc_id").select("doc_id", "lang", "toxic", "text"), model).collect()
    toxic, found, alarms = Counter(), Counter(), 0
    for r in scored:
        hit = r.score >= toxicity.TOXIC
        if r.toxic:
            toxic[r.lang] += 1
            found[r.lang] += hit
        else:
            alarms += hit
    assert len(toxic) == 4 and all(found[lang] >= 0.65 * n for lang, n in toxic.items()), (found, toxic)
    assert sum(found.values()) >= 0.82 * sum(toxic.values()) and alarms <= 0.005 * len(scored)


def test_scores_agree_with_a_plain_version():
    """Windows, codes, compression lengths and the curve, one after another without arrays."""
    import math
    import re

    import zstandard

    rows = texts(300)
    model = toxicity.fit(rows[:200])

    def coded(raw):
        out = bytearray()
        for i, byte in enumerate(raw):
            context = byte
            for back in range(1, 4):
                if i - back < 0 or (back > 1 and raw[i - back + 1] == 32):
                    break
                context |= raw[i - back] << (8 * back)
            out += (((context * 2654435761) & 0xFFFFFFFF) >> 16).to_bytes(2, "little")
        return bytes(out)

    def lengths(content, pieces):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=toxicity._settings())
        c = zstandard.ZstdCompressor(dict_data=d, compression_params=toxicity._settings())
        return [len(c.compress(p)) for p in pieces]

    def score(text):
        raw = (" " + " ".join(re.findall(r"[^\W\d_]+", (text or "").lower())) + " ").encode()
        pieces, start, code = [], 0, coded(raw)
        while start < len(raw):
            end = min(len(raw), start + toxicity.WINDOW)
            # A window ends before a blank, as late as it can; or where it is full.
            cut = next((e for e in range(end, start, -1) if raw[e : e + 1] == b" "), end)
            pieces.append(code[2 * start : 2 * cut])
            start = cut
        d = [b - a for a, b in zip(lengths(model.toxic, pieces), lengths(model.ordinary, pieces), strict=True)]
        top = (sorted(d, reverse=True) + [0] * 5)[:5]
        found = [sum(x >= least for x in d) for least in (3, 6)]
        x = [*(min(t, 12) for t in top), math.log1p(sum(t for t in d if t > 0)), found[0] / len(d), *map(math.log1p, found), sum(d) / len(d)]
        z = model.weights[0] + sum(w * v for w, v in zip(model.weights[1:], x, strict=True))
        return 1 / (1 + math.exp(-max(-30, min(30, z))))

    odd = ["", None, "a", "x" * 500, "Ünïcödé wörds " * 30, "vilewort grimhex " * 3]
    some = [t for _, t, _ in rows[200:]] + odd
    for got, text in zip(model.scorer()(some), some, strict=True):
        assert math.isclose(got, score(text), rel_tol=1e-9, abs_tol=1e-12)
