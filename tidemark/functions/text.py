"""Portable text functions.  Every function takes and returns Columns and stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def concat(*fields: Column | str) -> Column:
    """Join texts; null if any part is null."""
    return F.concat(*[_text(f) for f in fields])


def hash_text(field: Column | str) -> Column:
    """Lower-case hex MD5 of the value's text; null stays null."""
    return F.md5(_text(field).cast("string"))


def length(text: Column | str) -> Column:
    """Length in characters, not bytes."""
    return F.length(_text(text))


def position(needle: Column, haystack: Column | str) -> Column:
    """1-based place of ``needle`` in ``haystack``, 0 when absent."""
    return F.position(needle, _text(haystack))


def replace(field: Column | str, old: Column | str, new: Column | str) -> Column:
    """Replace every occurrence of ``old``; plain strings for ``old`` and ``new`` are literals."""
    as_literal = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.replace(_text(field), as_literal(old), as_literal(new))


def right(text: Column | str, n: Column | int) -> Column:
    """The last ``n`` characters; an empty text for 0."""
    return F.right(_text(text), F.lit(n) if isinstance(n, int) else n)


def split_part(text: Column | str, delimiter: Column | str, part: int) -> Column:
    """The ``part``-th piece around a literal delimiter, counted from 1, or from the end when negative."""
    if part == 0:
        raise ValueError("split_part counts from 1 or from -1, not from 0")
    as_literal = F.lit(delimiter) if isinstance(delimiter, str) else delimiter
    return F.split_part(_text(text), as_literal, F.lit(part))


def escape_single_quotes(text: Column | str, style: str = "double") -> Column:
    """Escape single quotes by doubling them, or with a backslash."""
    escaped = {"double": "''", "backslash": "\\'"}
    if style not in escaped:
        raise ValueError(f"unknown escaping style {style!r}")
    return F.replace(_text(text), F.lit("'"), F.lit(escaped[style]))


def string_literal(value: str) -> Column:
    return F.lit(value)


def bool_to_text(flag: Column | str) -> Column:
    """'true', 'false' or null."""
    return _text(flag).cast("string")


def mask_tail(text: Column | str, keep: int = 2, mask: str = "*") -> Column:
    """Keep the first characters and cover the rest, leaving the length unchanged."""
    value = _text(text)
    hidden = F.greatest(F.length(value) - F.lit(keep), F.lit(0))
    return F.concat(F.left(value, F.lit(keep)), F.repeat(F.lit(mask), hidden))
