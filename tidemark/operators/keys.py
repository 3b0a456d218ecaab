"""Key handling shared by the loading, history and comparison operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def resolve(df: DataFrame, name: str) -> str:
    """The frame's own spelling of a column name (names compare without case)."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"column {name!r} not found among {df.columns}")
    return found[0]


def normalise_key(key: str | Sequence[str] | None, *frames: DataFrame) -> list[str]:
    """A key as a list of distinct column names.

    None, an empty text and an empty list all mean 'no key'; repeated names are tolerated; a name missing from any
    frame is an error.
    """
    names = [key] if isinstance(key, str) else list(key or [])
    names = list(dict.fromkeys(n for n in names if n))
    for frame in frames:
        for name in names:
            resolve(frame, name)
    return [resolve(frames[0], n) for n in names] if frames else names


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def key_match(left: str, right: str, key: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition between two aliased frames; with ``null_safe`` null parts match each other."""
    pairs = [(F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")) for k in key]
    return all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def no_null(key: Sequence[str]) -> Column:
    """Every part of the key is present."""
    return all_of([F.col(f"`{k}`").isNotNull() for k in key])


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The complete keys, each once.  Partial aggregation keeps a hot key to one row per input partition."""
    return df.select(*[f"`{k}`" for k in key]).filter(no_null(key)).distinct()


#: Copies of a key that may remain in a key list for a semi or anti join.
SPREAD = 32


def key_list(df: DataFrame, key: Sequence[str], with_nulls: bool = False) -> DataFrame:
    """Keys for the right side of a semi or anti join: each a few times at most, which such joins ignore.

    Keys are made distinct per slice of the input.  A hot key shrinks to a few rows, and as the slices are not the
    join's partitions the list is shuffled plainly for the join.  That leaves the join between two plain shuffles, the
    only shape in which adaptive execution splits a hot key on the left side.
    """
    keys = df.select(*[F.col(f"`{k}`") for k in key])
    keys = keys if with_nulls else keys.filter(no_null(key))
    return keys.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SPREAD))).distinct().drop("_slice")


#: Bits of the filters that tell rows whose key may be among others: as many as 16 for each key, within these bounds.
LEAST_BITS, MOST_BITS = 16, 26


def probably_among(df: DataFrame, wanted: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is among the keys of ``wanted``, and a few others.

    A Bloom filter of the wanted keys is made by one aggregation and joined to the rows: at most 2**26 bits, a million words,
    so it is broadcast and ``df`` is not shuffled.  Keys with a null are among none.  Past four million keys the filter fills up
    and lets more rows through.  Both sides' keys must have the same types.
    """
    names = [F.col(f"`{k}`") for k in key]
    bits = max(LEAST_BITS, min(MOST_BITS, (16 * wanted.count()).bit_length()))
    at, word, held = free_names(df.columns, "_at", "_word", "_bits")

    def placed(rows: DataFrame) -> DataFrame:
        complete = rows.filter(no_null(key))
        numbered = complete.withColumn(at, F.xxhash64(*names).bitwiseAND(F.lit((1 << bits) - 1)))
        return numbered.withColumn(word, F.shiftright(at, 6))

    bit = F.expr(f"shiftleft(1L, cast(`{at}` & 63 as int))")
    words = placed(wanted.select(*names)).groupBy(word).agg(F.bit_or(bit).alias(held))
    met = placed(df).join(F.broadcast(words), word)
    return met.filter(F.col(held).bitwiseAND(bit) != 0).select(*[F.col(f"`{c}`") for c in df.columns])


def free_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that are not taken (names compare without case)."""
    lower = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in lower:
            name += "_"
        out.append(name)
    return out


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys occurring more than once; only the key columns are read, and counted before the shuffle."""
    counted = df.groupBy(*[F.col(f"`{k}`") for k in key]).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.filter(F.col("_copies") > 1).drop("_copies")


def error_if_any(rows: DataFrame, message: str, schema: T.StructType) -> DataFrame:
    """An always empty frame of a schema that fails at run time if ``rows`` holds any row.

    The count stands between the rows and the error, so the optimiser can neither drop the check nor run it early.
    """
    counted = rows.agg(F.count(F.lit(1)).alias("_rows"))
    failing = F.when(F.col("_rows") > 0, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(False))
    return counted.filter(failing).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def is_true(condition: Column) -> Column:
    """SQL's reading of a condition: null counts as false, so a negation never loses rows."""
    return F.coalesce(condition, F.lit(False))


def as_condition(condition: Column | str | Sequence[Column | str] | None) -> Column | None:
    """One Column from a Column, a SQL text, or several of them joined by AND."""
    if condition is None:
        return None
    if isinstance(condition, str):
        return F.expr(condition)
    if isinstance(condition, (list, tuple)):
        return all_of([as_condition(c) for c in condition]) if condition else None
    return condition
