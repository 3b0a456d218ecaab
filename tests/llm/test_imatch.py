"""Fingerprints against plain Python with the same lexicon, edited texts against slicing."""

import hashlib
import os
import random
import re

import pytest

from tidemark.llm import imatch, queries

SF = "/root/testdata/sf0.01"


def corpus(n, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 4))) for _ in range(900)]
    return [(10 + 3 * i, " ".join(rng.choices(words, k=rng.randint(20, 200)))) for i in range(n)]


ODD = [
    (None, "a null id"), (None, None), (1, ""), (2, None), (3, "!!! ???"), (4, "\U0001f600" * 9), (5, "é" * 7 + " word"),
    (6, "same"), (6, "same"), (6, "other"), (7, "x y z " * 20000), (10_000, "last one"),
]


def edited(rows):
    """(id, text, edited text) by id, null ids first; rows of equal id in any order that the caller sorts out."""
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        out.append((doc, text, text[: len(text) - q] + after[:q]))
    return out


def test_edited_texts_and_lengths(spark):
    rows = corpus(40) + [r for r in ODD if r[0] is not None and r[0] != 6]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.compare_edited(df).collect()}
    for doc, text, changed in edited(sorted(rows)):
        assert got[doc].n_chars == len(text), doc
        assert got[doc].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest(), doc
        assert 0 <= got[doc].near_edited <= 1 and 0 <= got[doc].near_next <= 1


def test_odd_rows_keep_their_number(spark):
    df = spark.createDataFrame([(*r, "x") for r in ODD + corpus(5)], "doc_id long, text string, h string")
    out = imatch.compare_edited(df)
    assert out.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ODD + corpus(5))
    same = [r.fingerprint for r in got if r.doc_id == 6]
    assert len(set(same)) == 2 and max(map(same.count, same)) == 2


def test_one_row_follows_itself_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab cd ef gh")], "doc_id long, text string")
    (r,) = imatch.compare_edited(df).collect()
    assert r.edited_sha256 == hashlib.sha256(b"ab cd ef ab").hexdigest() and r.near_next == 1
    assert imatch.compare_edited(df.limit(0)).collect() == []


def test_fingerprints_agree_with_plain_python(spark):
    rows = corpus(120) + [(5, "zzz"), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = sorted({w for _, t in rows for w in re.findall(r"[^\W_]+", t.lower())})
    words = spark.createDataFrame([(w,) for w in terms], "w string").selectExpr("w", "xxhash64(w) as x").collect()
    hashed = {r.w: r.x for r in words}
    frequency = {}
    for _, t in rows:
        for cell in {hashed[w] % imatch.CELLS for w in re.findall(r"[^\W_]+", t.lower())}:
            frequency[cell] = frequency.get(cell, 0) + 1
    low, high = (b * len(rows) for b in imatch.BAND)

    def md5(parts, n):
        return hashlib.md5(parts.encode()).hexdigest()[:n]

    def hexed(x):
        return f"{x % (1 << 64):X}"

    got = {r.doc_id: r.fingerprint.split(" ") for r in imatch.compare_edited(df).collect()}
    for doc, text in rows:
        own = sorted({hashed[w] for w in re.findall(r"[^\W_]+", text.lower())})
        found = [x for x in own if low <= frequency[x % imatch.CELLS] <= high]
        if not own:
            want = ["t" + md5(text, 8)]
        elif not found:
            want = ["a" + md5(",".join(map(hexed, own)), 6)]
        else:
            want, groups = ["l" + md5(",".join(map(hexed, found)), 6)], {}
            for x in found:
                if (s := (x % (1 << 64)) >> (64 - imatch.CLASS_BITS)) < imatch.SUBSETS:
                    groups.setdefault(s, []).append(x)
            for xs in groups.values():
                want.append(md5("".join("," + hexed(x) for x in xs), 6))
        assert sorted(got[doc]) == sorted(want), doc


def test_every_term_of_the_lexicon_enters_a_subset(spark):
    """A text of any one term has an entry beside that of the whole lexicon, so one lost term leaves the others' entries."""
    lone = [(1000 + i, f"term{i}") for i in range(40)]
    df = spark.createDataFrame(corpus(40) + lone, "doc_id long, text string")
    got = {r.doc_id: r.fingerprint.split(" ") for r in imatch.compare_edited(df).collect()}
    assert [len(got[doc]) for doc, _ in lone] == [2] * len(lone)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_edited_documents_are_nearer_than_next_ones(spark):
    got = queries.op6_imatch(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    digests = {r.doc_id: r.edited_sha256 for r in got}
    assert all(digests[d] == hashlib.sha256(e.encode()).hexdigest() for d, _, e in edited(docs))
    texts = dict(docs)
    by_text = {}
    for r in got:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(corpus(5), "doc_id long, text string")
    plan = imatch.lexicon(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
