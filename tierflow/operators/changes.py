"""What changed between two states of a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import NESTED


def state(df: DataFrame, key: str, version: str) -> DataFrame:
    """(key, ``_version``, ``_digest``): a row's version and a hash of all its columns.

    Rows of equal version may differ, since an incoming row wins over a stored one.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, NESTED)]
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, NESTED)]
    digest = F.xxhash64(*plain, *[F.to_json(F.struct(c)) for c in nested])
    return df.select(key, F.col(version).alias("_version"), digest.alias("_digest"))


def changed_keys(before: DataFrame, after: DataFrame, key: str, version: str) -> DataFrame:
    """(key, ``change``): keys that were added, removed or updated, by one full outer merge."""
    old = state(before, key, version).select(key, F.struct("_version", "_digest").alias("_old"))
    new = state(after, key, version).select(key, F.struct("_version", "_digest").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "updated")
    )
    merged = old.join(new, key, "full_outer").select(key, change.alias("change"))
    return merged.where(F.col("change").isNotNull())
