"""Example queries: importing this package registers them all."""

from tidemark.demos import clauses, functions, history, loading, managed, parts, quality, streams, tables  # noqa: F401
from tidemark.demos.loading import flagship
from tidemark.demos.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
