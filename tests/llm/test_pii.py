"""Spans against plain regular expressions, disclosing terms against plain counts."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

TEXTS = [
    "mail a.b@c.de, also x@y and _q@w.e.r_t@u.io; server 10.0.0.1.2.3.4 or 300.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 1-2--3, call +49 (30) 123-456-78.",
    "\x01mail\x02 me@home.org\x01 \U0001f600 you@home.org",
    "", None, "none here", "+1", "a@b.c" * 50, "1." * 300, "é@é.com ü+x@dom-ain.co.uk.", "0010.020.0003.255",
    "7 " * 3000 + "8", "x" * 50000 + "@" + "y" * 1000 + ".com", "5500005555555559 " * 40,
    "wren told kim@site.net about zanzibar", "zanzibar knows kim@site.net", "the kim@site.net told", "the of told about",
    "zanzibar knows kim@site.net", "about about told knows the",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    spans = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), pii.KINDS.index(kind), m.end(), m[0]))
    return sorted(spans)


def entity(span):
    return span[1], re.sub("[^0-9]", "", span[3]) if span[1] in (2, 3) else span[3].lower()


def with_terms(texts):
    """All spans of each text."""
    found = [base(t) for t in texts]
    words = [
        [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", t or "")]
        for t in texts
    ]
    n_t, n_c, n_ct = Counter(), Counter(), Counter()
    places = []
    for spans, ws in zip(found, words):
        n_t.update({w for _, _, w in ws})
        n_c.update({entity(s) for s in spans})
        here = defaultdict(set)
        for s in spans:
            for a, b, w in ws:
                near = (a >= s[0] - pii.REACH and b <= s[0]) or (a >= s[2] and b <= s[2] + pii.REACH)
                if near and not any(x[0] < b and a < x[2] for x in spans):
                    here[entity(s), w].add((a, b))
        n_ct.update(here.keys())
        places.append(here)
    out = []
    n = len(texts)
    for spans, here in zip(found, places):
        terms = set()
        for (c, w), at in here.items():
            ic = math.log(n / n_c[c])
            pmi = math.log(n * n_ct[c, w] / (n_c[c] * n_t[w]))
            if n_ct[c, w] >= pii.SUPPORT and ic > 0 and pmi >= pii.THRESHOLD * ic - 1e-9:
                terms |= at
        out.append(sorted([s[:3] for s in spans] + [(a, 4, b) for a, b in terms]))
    return out


def listed(spans):
    return ",".join(f"{pii.KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(df, ["doc_id"]).collect()}
    want = with_terms(texts)
    for i, text in enumerate(texts):
        spans = base(text)
        assert got[i].spans == listed(want[i]), (i, text)
        assert got[i].base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS[:4]] == [sum(s[1] == j for s in spans) for j in range(4)]
    return want


def test_spans_agree_with_brute_force(spark):
    want = check(spark, TEXTS)
    assert any(s[1] == 4 for spans in want for s in spans)


def test_documents(spark):
    sf = "/root/testdata/sf0.001/documents.parquet"
    pytest.importorskip("pathlib")
    import os

    if not os.path.exists(sf):
        pytest.skip("no test data")
    check(spark, [r.text for r in spark.read.parquet(sf).orderBy("doc_id").select("text").collect()])


def test_sanitise_keeps_columns_and_generalises(spark):
    rows = [(i, t, "r", 5) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, spans int")
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[14].text == "wren told [EMAIL] about [TERM]" and got[5].text == TEXTS[5] and got[4].text is None
    assert got[2].text == "\x01mail\x02 [EMAIL]\x01 \U0001f600 [EMAIL]"
    assert {(r.row, r.spans) for r in got.values()} == {("r", 5)}


def whole_texts(texts):
    """All spans of each text: counts over documents, and every place of a disclosing term."""
    found = [base(t) for t in texts]
    words = [[(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", t or "")] for t in texts]
    free = [[w for w in ws if not any(s[0] < w[1] and w[0] < s[2] for s in spans)] for spans, ws in zip(found, words)]
    n_t, n_c, n_ct = Counter(), Counter(), Counter()
    for spans, ws in zip(found, words):
        terms, values = {w for _, _, w in ws}, {entity(s) for s in spans}
        n_t.update(terms)
        n_c.update(values)
        n_ct.update((c, w) for c in values for w in terms)
    told, n = set(), len(texts)
    for (c, w), both in n_ct.items():
        ic = math.log(n / n_c[c])
        if both >= pii.SUPPORT and ic > 0 and math.log(n * both / (n_c[c] * n_t[w])) >= pii.THRESHOLD * ic - 1e-9:
            told.add(w)
    return [sorted([s[:3] for s in spans] + [(a, 4, b) for a, b, w in own if w in told]) for spans, own in zip(found, free)]


def test_disclosing_terms_go_from_whole_texts(spark):
    far = " 12" * 40
    texts = ["zora: kim@site.net", f"kim@site.net{far} zora", f"zora{far}. zora: kim@site.net", "only zora here", *["plain"] * 100]
    want = whole_texts(texts)
    assert [sum(s[1] == 4 for s in spans) for spans in want[:4]] == [1, 1, 2, 1]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(df, ["doc_id"], everywhere=True).collect()}
    assert [got[i] for i in range(len(texts))] == [listed(spans) for spans in want]
    clean = {r.doc_id: r.text for r in pii.sanitise(df, everywhere=True).collect()}
    assert clean[3] == "only [TERM] here" and not any("zora" in t for t in clean.values())


def far_from_values():
    """Texts whose disclosing terms stand more than REACH characters from the value, on both sides of it."""
    far = " 12" * 40
    return ["zora, kim" + far + " kim@site.net", f"kim@site.net{far} zora", "only zora and kim here", *["plain"] * 200]


def test_terms_far_from_their_value_go(spark, tmp_path):
    from tidemark.llm import queries

    rows = list(enumerate(far_from_values()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spans for r in queries.op9_pii(spark, str(tmp_path)).collect()}
    # "site" and "net" stand in the value only, which is a span already.
    assert [got[i] for i in range(4)] == ["term:0:4,term:6:9,email:130:142", "email:0:12,term:133:137", "term:5:9,term:14:17", ""]


def test_terms_that_lower_case_would_cut_elsewhere(spark):
    """Lower-casing makes two characters of İ, one of them no letter, and looks beyond the word to choose a sigma."""
    far = " 12" * 40
    texts = [f"İzmirli ΟΔΟΣ.Α kim@site.net{far}", f"kim@site.net{far} İzmirli ΟΔΟΣ", "İzmirli ΟΔΟΣ, only", "zmirli only", *["plain"] * 200]
    want = whole_texts(texts)
    assert [sum(s[1] == 4 for s in spans) for spans in want[:4]] == [2, 2, 2, 0]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(df, ["doc_id"], everywhere=True).collect()}
    assert [got[i] for i in range(len(texts))] == [listed(spans) for spans in want]


def test_a_hot_value_and_a_hot_term(spark):
    texts = [f"zora{' 12' * 40} kim@site.net own{chr(97 + i % 26) * 3}" for i in range(40)] + ["zora knows"] * 2 + ["plain"] * 60
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(df, everywhere=True).collect()}
    assert got[40] == "[TERM] knows" and got[0] == f"[TERM]{' 12' * 40} [EMAIL] ownaaa".replace("ownaaa", "[TERM]")
    assert got[50] == "plain"


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_marks_whole_texts(spark, name):
    import os

    from tidemark.llm import queries

    sf = f"/root/testdata/{name}"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.spans for r in queries.op9_pii(spark, sf).collect()}
    want = whole_texts([r.text for r in rows])
    assert got == {r.doc_id: listed(spans) for r, spans in zip(rows, want)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.digest(df, ["doc_id"]).collect() == []
    assert pii.sanitise(df).collect() == []
