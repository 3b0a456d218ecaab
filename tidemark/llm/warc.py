"""WARC archives whose repeated payloads are stored once.

Writing: the pages' headers (id, size and digest, not payloads) are combined by payload digest to find each repeated payload's
original; joined back, every page but the original becomes a revisit record without payload.  Records are plain columns, and Spark's
text writer lays them out as gzipped archives of at most RECORDS_PER_FILE records, on whatever store the folder is.

Reading: a narrow map parses archives record by record, by their lengths; revisit records are joined to the headers of their
original responses by record id.

Payloads of equal digest and at least LEAST_BYTES bytes are one; the row with the largest id is the response.

Defined results: a null payload counts as empty; a row with a null id comes before all others; rows that repeat the largest id
and its payload are all responses (there is nothing to tell them apart); a null URL is ``urn:page:`` and the id; white space in
URLs is written as %20; columns beyond id, URL and payload are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 1_000
#: Records of one archive, at most: readers hold one compressed archive at a time.
RECORDS_PER_FILE = 4_000

_END = "\r\n"


def _uuid(value: Column) -> Column:
    h = F.md5(value.cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; fields that are null are left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")) for name, value in fields])


def originals(headers: DataFrame) -> DataFrame:
    """(digest, original): the largest id of each payload that several rows hold.  Combines before the shuffle."""
    return (
        headers.where(F.col("bytes") >= LEAST_BYTES)
        .groupBy("digest")
        .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and original is not null")
        .select(F.col("digest").alias("same"), "original")
    )


def write(
    pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", key: str = "page_id", url: str = "url", payload: str = "html"
) -> None:
    """Write one record for each page below ``path``.  ``date``: when the records are made."""
    source = pages.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha1(F.col("payload").cast("binary"))})
    known = source.join(originals(source.select("id", "bytes", "digest")), F.col("digest") == F.col("same"), "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))

    page = F.coalesce(F.col("id").cast("string"), F.lit("-"))
    target = F.coalesce(F.regexp_replace("url", r"\s", "%20"), F.concat(F.lit("urn:page:"), page))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("bytes").cast("string"),
        F.lit(_END * 2),
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("payload")))

    def record_id(of: Column) -> Column:
        return _uuid(F.concat_ws(" ", of, F.col("digest")))

    header = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(page)),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.when(revisit, record_id(F.col("original").cast("string")))),
        ("X-Page-Id", F.col("id").cast("string")),
        ("Content-Type", F.when(~revisit, "application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    record = F.concat(F.lit(f"WARC/1.1{_END}"), header, F.lit(_END), block, F.lit(_END))
    # The writer ends each row with the second of the two line ends behind a block.
    known.select(record.alias("value")).write.option("lineSep", _END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, gzipped or not."""
    raw = io.BytesIO(content)
    stream = gzip.open(raw) if content[:2] == b"\x1f\x8b" else raw
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {version[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _body(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    return block.partition(b"\r\n\r\n")[2]


def records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each record: record_id, type, page_id, url, bytes, digest, refers_to; with ``payloads`` also html.

    ``bytes`` and ``digest`` of a response are those of the payload read; a digest that differs from the header is an error.
    """
    schema = pa.schema(
        [(n, pa.int64() if n in ("page_id", "bytes") else pa.string()) for n in _FIELDS] + [("html", pa.string())] * payloads
    )

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                held = 0
                for headers, block in parse(content.as_py()):
                    rows.append(_row(headers, block)[: len(schema)])
                    held += len(block)
                    if len(rows) == 1_000 or held > 16_000_000:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                yield _batch(rows, schema)

    kinds = ", ".join(f"{n} {'bigint' if n in ('page_id', 'bytes') else 'string'}" for n in schema.names)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, kinds)


_FIELDS = ("record_id", "type", "page_id", "url", "bytes", "digest", "refers_to")


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    payload = _body(block) if kind == "response" else None
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    page = headers.get("x-page-id")
    return (
        headers["warc-record-id"], kind, None if page is None else int(page), headers.get("warc-target-uri"),
        None if payload is None else len(payload), digest, headers.get("warc-refers-to"),
        None if payload is None else payload.decode(),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def resolved(found: DataFrame) -> DataFrame:
    """Records with their full payload's size, and for revisits the original's page id, as ``payload_bytes`` and ``refers_to``.

    Joins revisits to the headers of original responses; responses need no join.
    """
    response = found.where("type = 'response'")
    revisit = found.where("type = 'revisit'").withColumnRenamed("refers_to", "wanted").drop("bytes")
    heads = response.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("wanted"), F.col("bytes").alias("payload_bytes"), F.col("page_id").alias("refers_to")
    )
    plain = response.withColumn("payload_bytes", F.col("bytes")).withColumn("refers_to", F.lit(None).cast("bigint"))
    both = revisit.join(heads, "wanted", "left").drop("wanted")
    return plain.select(both.columns).union(both)


def rewrite(spark: SparkSession, path: str, to: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Read archives and write them anew, deduplicated, with fresh headers.  Revisits get their original's payload back first."""
    found = records(spark, path, payloads=True)
    response = found.where("type = 'response'").select("page_id", "url", "html", "record_id")
    again = found.where("type = 'revisit'").select("page_id", "url", F.col("refers_to").alias("record_id"))
    bodies = response.dropDuplicates(["record_id"]).select("record_id", "html")
    write(
        response.select("page_id", "url", "html").union(again.join(bodies, "record_id", "left").select("page_id", "url", "html")),
        to, date,
    )
