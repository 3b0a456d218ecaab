"""Settling what interrupted loads have left."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.plans.filewise import FileSwap
from tidemark.plans.partitions import LIVE, Publication, journal_of
from tidemark.plans.publish import shape
from tidemark.session import Files


def recover(spark: SparkSession, table: str) -> None:
    """Settle what interrupted loads have left: undo those that were not committed, finish the others."""
    kind = shape(spark, table)
    if not kind.location:
        return
    files = Files(spark, kind.location)
    marks = files.names(journal_of(kind)) if files.exists(journal_of(kind)) else []
    for version in sorted({m.partition(".")[0] for m in marks}):
        step = (Publication if kind.partition_by else FileSwap)(spark, table, kind, version)
        # One that ended meanwhile has left neither mark.
        if version in LIVE or not any(files.exists(step.mark(state)) for state in ("begun", "committed")):
            continue
        if files.exists(step.mark("committed")):
            step.finish()
        else:
            step.undo()
        spark.catalog.refreshTable(table)
