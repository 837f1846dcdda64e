"""Broadcast only what is known to be small, without running a job to find out.

A table that is staged anyway tells its rows and bytes while it is written.  Any other frame
is left to Spark, which knows the sizes of files, and of shuffles while it runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.columns import NESTED
from tierflow.sources.scratch import staged

BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Sized:
    """A written table, and the rows and bytes that were observed while it was written."""

    df: DataFrame
    rows: int
    bytes: int


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 16 for each column, and the length of texts and of nested values."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, NESTED):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return width


def sized(df: DataFrame, purpose: str, *, keep: bool = False) -> Sized:
    """Stage ``df`` and observe its size on the way; one job, one pass."""
    figures = Observation()
    counted = df.observe(
        figures, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")
    )
    table = staged(counted, purpose, keep=keep)
    return Sized(table, figures.get["rows"], figures.get["bytes"])


def frame(table: DataFrame | Sized) -> DataFrame:
    return table.df if isinstance(table, Sized) else table


def is_small(table: DataFrame | Sized, max_bytes: int = BROADCAST_BYTES) -> bool:
    return isinstance(table, Sized) and table.bytes <= max_bytes


def broadcast_within(table: DataFrame | Sized, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table, marked for broadcast if its observed size is at most ``max_bytes``."""
    return F.broadcast(frame(table)) if is_small(table, max_bytes) else frame(table)
