"""Projections over declared and nested columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.keys import resolve


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Declared columns in declared order."""
    return df.select(*[F.col(f"`{resolve(df, n)}`").alias(n) for n in names])


def conform(value: Column, source: T.DataType, wanted: T.DataType) -> Column:
    """A value reshaped to a declared type: struct fields by name in declared order, missing ones null.

    Works at any depth through structs, arrays and the values of maps, whose keys are kept; a null struct stays null.
    """
    if isinstance(wanted, T.StructType) and isinstance(source, T.StructType):
        known = {f.name.lower(): f for f in source.fields}
        parts = []
        for want in wanted.fields:
            have = known.get(want.name.lower())
            part = F.lit(None).cast(want.dataType)
            if have is not None:
                part = conform(value.getField(have.name), have.dataType, want.dataType)
            parts.append(part.alias(want.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(source, T.ArrayType):
        if isinstance(wanted.elementType, (T.StructType, T.ArrayType, T.MapType)):
            return F.transform(value, lambda e: conform(e, source.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(source, T.MapType) and wanted.keyType == source.keyType:
        if isinstance(wanted.valueType, (T.StructType, T.ArrayType, T.MapType)):
            return F.transform_values(value, lambda _, v: conform(v, source.valueType, wanted.valueType))
    return value if source == wanted else value.cast(wanted)


def conform_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A frame reshaped to a declared schema, by name and at any depth; missing columns are null."""
    known = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for want in schema.fields:
        have = known.get(want.name.lower())
        if have is None:
            columns.append(F.lit(None).cast(want.dataType).alias(want.name))
        else:
            columns.append(conform(F.col(f"`{have.name}`"), have.dataType, want.dataType).alias(want.name))
    return df.select(*columns)


def leaf_columns(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all non-struct fields, depth first."""
    paths: list[tuple[str, ...]] = []
    for field in schema.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            paths.extend(leaf_columns(field.dataType, path))
        else:
            paths.append(path)
    return paths


def flatten(df: DataFrame) -> DataFrame:
    """Every struct leaf as a column named by its dotted path; arrays stay whole."""
    leaves = leaf_columns(df.schema)
    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)) for path in leaves])


def nest(df: DataFrame) -> DataFrame:
    """Columns with dotted names gathered into structs; the inverse of ``flatten`` up to null structs."""

    def build(tree: Mapping[str, object]) -> list[Column]:
        return [
            (F.struct(*build(sub)) if isinstance(sub, dict) else F.col(f"`{sub}`")).alias(name)
            for name, sub in tree.items()
        ]

    tree: dict = {}
    for column in df.columns:
        *parents, leaf = column.split(".")
        node = tree
        for parent in parents:
            node = node.setdefault(parent, {})
            if not isinstance(node, dict):
                raise ValueError(f"{column!r} needs {parent!r} as a struct, but it is a plain column")
        if leaf in node:
            raise ValueError(f"{column!r} occurs both as a plain column and as a struct")
        node[leaf] = column
    return df.select(*build(tree))
