"""Archives written, read back and rewritten, against the pages."""

import hashlib
import os
import uuid

import pytest

from tidemark.llm import queries, warc

SF = "/root/testdata/sf0.001"
LONG, OTHER = "é<p>" * 400, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40

PAGES = [
    (1, "http://a.org/x y\n", LONG), (2, "http://b.org/", LONG), (3, None, LONG), (4, "http://c.org/", "short"),
    (5, "http://d.org/", "short"), (6, "http://e.org/", None), (7, "http://f.org/", ""), (8, "u", OTHER), (9, "u", OTHER),
    (None, "n", OTHER), (10, "z", "x" * 999), (11, "z", "x" * 999), (12, "z", "x" * 1000), (13, "z", "x" * 1000),
    (14, "big", "long text \r\n\r\n" * 100_000), (3, None, LONG), (15, "s", "\U0001f600" * 249), (16, "s", "\U0001f600" * 250),
    (None, "m", "lonely " * 200), (None, "m", "lonely " * 200),
]


def want(pages):
    out = []
    payload = [(p or "").encode() for *_, p in pages]
    for (i, _, _), p in zip(pages, payload):
        same = [j for (j, *_), q in zip(pages, payload) if q == p and j is not None]
        original = max(same, default=None) if len(p) >= 1000 else i
        response = original is None or i == original
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if response else "revisit", None if response else original))
    return sorted(out, key=str)


def read(spark, path):
    rows = warc.resolved(warc.records(spark, path)).collect()
    return sorted(((r.page_id, r.payload_bytes, r.digest, r.type, r.refers_to) for r in rows), key=str)


@pytest.fixture
def pages(spark):
    rows = [(*r, i) for i, r in enumerate(PAGES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)


def test_round_trip(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write(pages, path)
    assert read(spark, path) == want(PAGES)


def test_rewriting_keeps_every_page(spark, pages, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write(pages, first)
    warc.rewrite(spark, first, second, date="2025-05-05T00:00:00Z")
    assert read(spark, second) == want(PAGES)
    texts = [r.html for r in warc.records(spark, second, payloads=True).collect() if r.type == "response"]
    assert {t for t in texts} == {p or "" for *_, p in PAGES}


def test_archives_are_well_formed(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 2)
    path = tmp_path / "a"
    warc.write(pages, str(path))
    files = sorted(path.glob("part-*.gz"))
    found = [r for f in files for r in warc.parse(f.read_bytes())]
    assert len(files) >= len(PAGES) // 2 and len(found) == len(PAGES)
    for headers, block in found:
        uuid.UUID(headers["warc-record-id"].removeprefix("<urn:uuid:").removesuffix(">"))
        assert " " not in headers["warc-target-uri"] and (headers["warc-type"] == "revisit") == (block == b"")
    assert read(spark, str(path)) == want(PAGES)


def test_broken_archives_are_errors():
    with pytest.raises(ValueError):
        list(warc.parse(b"nothing\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"))


def test_empty_table(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write(pages.limit(0), path)
    assert read(spark, path) == []


def test_pages(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = queries.op8_warc(spark, SF).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=str) == want(rows)
