"""Publishing tables: readers see the old content or the new, never a half-written one.

Every published version has a folder of its own.  Where old and new differ in their rows only, the table's location is
repointed in one step; otherwise two renames touch the catalog, on file systems and object stores alike.  Single partitions are
published by ``partitions``.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import remove_folder
from tidemark.sources.sinks import write_files, write_table

log = logging.getLogger(__name__)

#: Formats whose tables are folders of files that a write by path can replace.
PATH_FORMATS = ("parquet", "orc", "json", "csv", "text")


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType in ("VIEW", "TEMPORARY")


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the table exists, after undoing a publish that was interrupted between its two renames."""
    backup = f"{table}__backup"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(backup):
        log.warning("restoring %s from an interrupted publish", table)
        spark.sql(f"ALTER TABLE {backup} RENAME TO {table}")
    return spark.catalog.tableExists(table)


@dataclass(frozen=True)
class Shape:
    """How a table is stored and described."""

    provider: str
    location: str
    partition_by: list[str] = field(default_factory=list)
    bucket_by: list[str] = field(default_factory=list)
    buckets: int | None = None
    options: dict[str, str] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)
    comment: str | None = None
    column_comments: dict[str, str] = field(default_factory=dict)
    tracked: bool = False


def _listed(text: str) -> dict[str, str]:
    """``[a=b, c=d]`` as a dictionary."""
    pairs = [p.partition("=") for p in text.strip("[]").split(", ") if p]
    return {k: v for k, _, v in pairs}


def shape(spark: SparkSession, table: str) -> Shape:
    """A table's shape, from the catalog."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()  # columns and a few settings
    start = next(i for i, r in enumerate(rows) if r.col_name == "# Detailed Table Information")
    facts = {r.col_name: r.data_type for r in rows[start + 1 :]}
    columns = spark.catalog.listColumns(table)
    properties = {
        r["key"]: r["value"]
        for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()  # a handful of properties
        if not r["key"].startswith(("spark.sql.", "transient_"))
    }
    return Shape(
        provider=facts.get("Provider", "parquet").lower(),
        location=facts.get("Location", ""),
        partition_by=[c.name for c in columns if c.isPartition],
        bucket_by=re.findall(r"`([^`]+)`", facts.get("Bucket Columns", "")),
        buckets=int(facts["Num Buckets"]) if "Num Buckets" in facts else None,
        options={k: v for k, v in _listed(facts.get("Storage Properties", "")).items() if k != "serialization.format"},
        properties=properties,
        comment=facts.get("Comment"),
        column_comments={c.name: c.description for c in columns if c.description},
        tracked="Partition Provider" in facts,
    )


def _path(location: str) -> str:
    """The bare path of a location, so that ``file:/x``, ``file:///x`` and ``/x`` compare."""
    return "/" + unquote(urlparse(location).path).strip("/")


def is_below(location: str, root: str) -> bool:
    return _path(location).startswith(_path(root).rstrip("/") + "/")


def swap_in(spark: SparkSession, staged: str, table: str) -> None:
    """Put a finished table in the place of another: old to backup, new in, backup dropped.

    Between the two renames there is no table of that name; the next publish or load repairs an interruption there.
    """
    backup = f"{table}__backup"
    if not table_exists(spark, table):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        return
    if is_view(spark, table):
        spark.sql(f"DROP VIEW {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {backup}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {backup}")


def replace_table(
    df: DataFrame,
    table: str,
    file_format: str | None = None,
    partition_by: Sequence[str] | None = None,
    bucket_by: Sequence[str] | None = None,
    buckets: int | None = None,
    location: str | None = None,
    options: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Build the new content completely beside the table, then put it in the table's place.

    The query may read the table it replaces.  What is not given (format, partitions, buckets, place, options) is taken
    from the table that is replaced; its properties and comments are kept.  Versions live below ``location``, by
    default a folder of the database; the folder of the replaced version is removed at the end.
    """
    spark = df.sparkSession
    old = shape(spark, table) if table_exists(spark, table) and not is_view(spark, table) else None
    version = uuid.uuid4().hex
    root = versions_root(spark, table, location or (_root_of(old) if old else None))
    known = old or Shape(provider="parquet", location="")
    file_format = file_format or known.provider
    partition_by = list(known.partition_by if partition_by is None else partition_by)
    if bucket_by is None and not buckets:
        bucket_by, buckets = [c for c in known.bucket_by if c in df.columns], known.buckets
        bucket_by, buckets = (bucket_by, buckets) if len(bucket_by) == len(known.bucket_by) else ([], None)
    options = dict(known.options if options is None and file_format == known.provider else options or {})
    commented = df
    for column, comment in known.column_comments.items():
        if column in df.columns:
            commented = commented.withMetadata(column, {**df.schema[column].metadata, "comment": comment})

    target = f"{root}/{version}"
    plain = not partition_by and not buckets and file_format in PATH_FORMATS
    same = old is not None and plain and not old.partition_by and not old.buckets and file_format == old.provider
    if same and options == old.options and _types(df) == _types(spark.table(table)):
        write_files(df, target, file_format=file_format, options=options)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
        _set_properties(spark, table, properties or {})
        spark.catalog.refreshTable(table)
    else:
        staged = f"{table}__stage_{version[:8]}"
        write_table(
            commented,
            staged,
            file_format=file_format,
            partition_by=partition_by,
            bucket_by=bucket_by or (),
            buckets=buckets,
            location=target,
            options=options,
        )
        _set_properties(spark, staged, {**known.properties, **(properties or {})})
        if known.comment:
            spark.sql(f"COMMENT ON TABLE {staged} IS {quoted(known.comment)}")
        swap_in(spark, staged, table)
    if old is not None and is_below(old.location, root):
        remove_folder(spark, old.location)


def _types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    if properties:
        listed = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def properties_of(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}  # a handful


def set_properties(spark: SparkSession, table: str, **properties: str) -> None:
    _set_properties(spark, table, properties)


def _root_of(old: Shape) -> str | None:
    """The folder that holds a table's versions, if its location is one."""
    head, _, last = old.location.rstrip("/").rpartition("/")
    return head if re.fullmatch(r"[0-9a-f]{32}", last) else None


def versions_root(spark: SparkSession, table: str, location: str | None = None) -> str:
    """The folder the versions of a table live in."""
    if location:
        return location.rstrip("/")
    *database, name = table.split(".")
    home = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{name}__versions"


def table_location(spark: SparkSession, table: str) -> str:
    return shape(spark, table).location


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def has_partition(spark: SparkSession, table: str, **values: str) -> bool:
    spec = ", ".join(f"`{c}` = {quoted(v)}" for c, v in values.items())
    return not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").isEmpty()
