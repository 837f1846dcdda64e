"""Projection helpers: renames, casts, keys, JSON and element access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.ArrayType, T.MapType, T.StructType)


def rename_by_position(df: DataFrame, source: T.StructType, target: T.StructType) -> DataFrame:
    """Give the i-th column of ``source`` the i-th name of ``target``.

    All names change at once, so swapped names work.  Columns outside ``source`` pass
    through behind the renamed ones.
    """
    if len(source) != len(target):
        raise ValueError(f"cannot rename {len(source)} columns to {len(target)} names")
    renamed = [F.col(a).alias(b) for a, b in zip(source.names, target.names)]
    taken = set(source.names)
    return df.select(*renamed, *[c for c in df.columns if c not in taken])


def conform(df: DataFrame, schema: T.StructType, *, lenient: bool = False, keep=()) -> DataFrame:
    """Project to exactly the names, order and types of ``schema``.

    ``lenient`` turns values that do not fit the type into NULL instead of failing the
    job.  ``keep`` names helper columns carried along unchanged.
    """
    def cast(field: T.StructField) -> Column:
        col = F.col(field.name)
        fitted = col.try_cast(field.dataType) if lenient else col.cast(field.dataType)
        return fitted.alias(field.name)

    return df.select(*map(cast, schema.fields), *keep)


def whole(col: Column, kind: T.DataType) -> Column:
    """Truncate a number towards zero; NULL when it does not fit ``kind``.

    The way to int is over long, since Spark takes decimals to int by way of double.
    """
    return col.try_cast(T.LongType()).try_cast(kind) if kind == T.IntegerType() else col.try_cast(kind)


def first(col: Column) -> Column:
    """First array element, NULL for an empty or NULL array."""
    return F.get(col, F.lit(0))


def composite_key(*parts: Column) -> Column:
    """``a_b``; NULL as soon as one part is NULL (``concat_ws`` would skip it)."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Encode every array, map and struct column as JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, NESTED)]
    return df.withColumns({name: F.to_json(name) for name in nested}) if nested else df
