"""What the operators of this package share: names that cannot clash, batches within a size, folds, and reading tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of about this many characters are worked on at once inside a task.
BATCH_CHARS = 4_000_000

#: Bits of the filters that tell which rows may be concerned.
FILTER_BITS = 1 << 23

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(df: DataFrame, least: int = 0) -> int:
    """How many shuffle partitions the session asks for."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def crc32_mod(column: Column, n: int) -> Column:
    """crc32 of a value's text, modulo ``n``; null stays null."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(n))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, with underscores added until no column of a frame has that name (names ignore case in Spark)."""
    lower = {t.lower() for t in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def chunks(table: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts stay near BATCH_CHARS bytes; a single longer text is a slice of its own."""
    sizes = pc.utf8_length(table.column(column)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > BATCH_CHARS:
            yield table.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < table.num_rows:
        yield table.slice(start)


def _filter_words(wanted: DataFrame, key: str) -> np.ndarray:
    """The filter's words: the bit of every ``key`` (a hash, bigint) in ``wanted`` is set."""
    at = F.pmod(key, F.lit(FILTER_BITS))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    bits = wanted.select(at.alias("at")).select(F.shiftright("at", 6).alias("i"), bit.alias("b"))
    rows = bits.groupBy("i").agg(F.bit_or("b").alias("b")).collect()  # FILTER_BITS / 64 rows at most
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        words[r.i] = r.b
    return words


def marked_by(df: DataFrame, wanted: DataFrame, key: str) -> Callable[[bool], DataFrame]:
    """Rows of ``df`` whose ``key`` (a hash, bigint, not null) is in ``wanted`` and few others (True), and the rest (False).

    The filter is that of ``concerned_by``, as a broadcast row; no row goes to Python for it.
    """
    words = free_name("words", df.columns)
    held = pa.table({words: pa.array([_filter_words(wanted, key)], pa.list_(pa.int64()))})
    row = F.broadcast(df.sparkSession.createDataFrame(held))
    at = F.pmod(key, F.lit(FILTER_BITS))
    word = F.get(words, F.shiftright(at, 6).cast("int"))
    hit = F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1
    return lambda inside: df.join(row, hit, "left_semi" if inside else "left_anti")


def concerned_by(wanted: DataFrame, key: str) -> Callable[[bool], Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]:
    """Filters of batches: of rows whose ``key`` (a hash, bigint) is in ``wanted`` and few others (True), and of the rest (False).

    A filter of fixed size decides, so nothing is shuffled; as it fills, it lets more other rows through.
    """
    shared = wanted.sparkSession.sparkContext.broadcast(_filter_words(wanted, key))

    def chosen(inside: bool):
        def run(batches):
            words = shared.value
            for batch in batches:
                bit = batch.column(key).to_numpy() % FILTER_BITS
                hit = ((words[bit >> 6] >> (bit & 63)) & 1).astype(bool)
                yield batch.filter(pa.array(hit == inside))

        return run

    return chosen


def concerned(df: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` (a hash, bigint) is in ``wanted`` and few others, and the rest."""
    chosen = concerned_by(wanted, key)
    return df.mapInArrow(chosen(True), df.schema), df.mapInArrow(chosen(False), df.schema)


def with_text_columns(
    df: DataFrame, text: str, added: Sequence[tuple[str, T.DataType]], fn: Callable[[], Callable], keep: Sequence[str]
) -> DataFrame:
    """``df``'s ``keep`` columns with ``added`` ones that are made from the texts.

    ``fn`` is called once in each task and returns a function from a list of texts (None for null) to one list for
    each added column.
    """
    fields = [f for f in df.schema.fields if f.name in keep]
    inner = free_name("text", [f.name for f in fields])
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in added)])
    arrow = [(n, _arrow_type(t)) for n, t in added]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = fn()
        for batch in batches:
            for part in chunks(batch, inner):
                got = made(part.column(inner).to_pylist())
                arrays = [part.column(n) for n in names]
                arrays += [pa.array(v, type=t) for v, (_, t) in zip(got, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *(n for n, _ in arrow)])

    source = df.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text}`").cast("string").alias(inner))
    return source.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
        "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
        "array<bigint>": pa.list_(pa.int64()),
    }
    return simple[kind.simpleString()]
