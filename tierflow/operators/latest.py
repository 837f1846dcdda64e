"""Latest row per key, and its use to merge new rows into stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.filters import with_required
from tierflow.operators.sizing import BROADCAST_BYTES, Sized, frame, is_small


def latest_per_key(
    df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[Column] = ()
) -> DataFrame:
    """Keep the row with the highest ``version`` of each key; NULL keys are dropped.

    ``ties`` orders rows of equal version and should make the order total.  Spark keeps
    one row per key on the map side (partial ``WindowGroupLimit``) before it shuffles,
    so a key that holds most of the input sends one row per map task.
    """
    ranked = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(version), *ties)
    return (
        with_required(df, keys)
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def merge_latest(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    version: str,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Latest row per key over both inputs; on equal versions an incoming row wins.

    ``ties`` orders incoming rows of equal version; it may use helper columns that
    ``stored`` lacks, which do not reach the result.
    """
    both = incoming.withColumn("_arrival", F.lit(0)).unionByName(
        stored.withColumn("_arrival", F.lit(1)), allowMissingColumns=True
    )
    ordered = latest_per_key(both, keys, version, [F.asc("_arrival"), *ties])
    return ordered.select(*stored.columns)


def merge_changed(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    version: str,
    ties: Sequence[Column] = (),
    changed: DataFrame | Sized | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``merge_latest`` of the stored rows whose keys come in again; all others stay as they are.

    ``changed`` holds at least the keys of ``incoming`` and should be cheap to scan.  If its
    size is known and small it is broadcast, and stored rows of other keys pass from scan to
    write without a shuffle or a sort.  Otherwise the same plan meets the keys by a join that
    Spark picks.  The result is the same either way, also if ``stored`` has a key twice.
    """
    given = incoming if changed is None else changed
    small = is_small(given, max_bytes)
    wanted = with_required(frame(given), keys).select(*keys)
    wanted = F.broadcast(wanted) if small else wanted  # semi and anti joins need no distinct keys
    known = with_required(stored, keys)
    touched = known.join(wanted, list(keys), "left_semi").select(*stored.columns)
    others = known.join(wanted, list(keys), "left_anti").select(*stored.columns)
    return others.unionByName(merge_latest(touched, incoming, keys, version, ties))


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Union all by column name; every input must have the same columns."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
