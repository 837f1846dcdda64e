"""Promote raw rows to the trusted zone: one latest row per key."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import conform, rename_by_position
from tierflow.operators.filters import (
    lacks_any, nothing_in, on_dates, with_required, without_required,
)
from tierflow.operators.latest import latest_per_key, merge_changed
from tierflow.operators.metrics import observed
from tierflow.operators.sizing import Sized, sized
from tierflow.plans.raw_load import RejectedRows, check_policy
from tierflow.sinks.files import (
    clear_quarantine, publish_snapshot, quarantine, read_snapshot, snapshots,
)
from tierflow.sources.scratch import job_scratch
from tierflow.sources.tables import open_table
from tierflow.specs import (
    RAW_TRAFFIC,
    RAW_WEATHER,
    TRUSTED_TRAFFIC,
    TRUSTED_WEATHER,
    TableSpec,
)


@dataclass(frozen=True)
class Promotion:
    """The published snapshot and the figures observed while it was written."""

    snapshot: int
    rows_read: int
    rows_rejected: int


def promote_weather(spark: SparkSession, base_dir: str, batch_id: str, **options) -> Promotion:
    return promote(spark, RAW_WEATHER, TRUSTED_WEATHER, base_dir, batch_id, **options)


def promote_routes(spark: SparkSession, base_dir: str, batch_id: str, **options) -> Promotion:
    return promote(spark, RAW_TRAFFIC, TRUSTED_TRAFFIC, base_dir, batch_id, **options)


def promote(
    spark: SparkSession,
    raw: TableSpec,
    trusted: TableSpec,
    base_dir: str,
    batch_id: str,
    *,
    dates: Iterable[str] | DataFrame | Sized | None = None,
    on_error: str = "quarantine",
) -> Promotion:
    """Merge raw rows with the trusted table and publish the result.

    ``dates`` (values, or the written table of a load's report) limits the scan to the raw
    partitions that changed since the last promotion.  The outcome is that of a full scan, because a trusted row is already the
    latest of everything promoted before.  With no dates nothing is published, and the
    snapshot in force (0 if there is none) is reported with zero figures.
    """
    check_policy(on_error)
    if dates is not None and not isinstance(dates, (DataFrame, Sized)):
        dates = list(dates)
    if nothing_in(dates):  # a batch of rejects only has changed nothing
        complete, _ = snapshots(spark, trusted.path(base_dir))
        return Promotion(complete[-1] if complete else 0, 0, 0)
    history = open_table(spark, raw.path(base_dir), raw.schema)
    history = on_dates(history, dates, raw.partition)
    incomplete = F.count(F.when(lacks_any(raw.required), 1))
    if on_error == "fail":
        bad = history.agg(incomplete.alias("bad")).first()["bad"]
        if bad:
            raise RejectedRows(f"{raw.name}: {bad} rows lack a required field")

    with job_scratch(spark):
        counted, figures = observed(history, {"rows": F.count(F.lit(1)), "incomplete": incomplete})
        incoming = to_trusted(with_required(counted, raw.required), raw, trusted)
        keys = history.select(F.col(raw.key).alias(trusted.key)).distinct()
        merged = merge_snapshot(spark, base_dir, incoming, trusted, keys)
        number = publish_snapshot(merged, trusted.path(base_dir))
    if figures.get["incomplete"]:
        rejects = without_required(history, raw.required)
        quarantine(rejects, trusted.quarantine_path(base_dir), batch_id)
    else:
        clear_quarantine(spark, trusted.quarantine_path(base_dir), batch_id)
    return Promotion(number, figures.get["rows"], figures.get["incomplete"])


def to_trusted(rows: DataFrame, raw: TableSpec, trusted: TableSpec) -> DataFrame:
    """Raw column names and types to trusted ones, column by column in order."""
    return conform(rename_by_position(rows, raw.schema, trusted.schema), trusted.schema)


def merge_trusted(
    stored: DataFrame, incoming: DataFrame, trusted: TableSpec, changed: DataFrame | Sized
) -> DataFrame:
    """Latest row per key over all dates; between equal versions the newest date wins.

    ``changed`` has at least the keys of ``incoming``.
    """
    return merge_changed(
        stored, incoming, [trusted.key], trusted.version, [F.desc("dt")], changed
    )


def merge_snapshot(
    spark: SparkSession, base_dir: str, incoming: DataFrame, trusted: TableSpec, keys: DataFrame
) -> DataFrame:
    """``merge_trusted`` with the snapshot in force, for which ``keys`` is staged and sized; the
    first rows of a table meet no stored ones."""
    path = trusted.path(base_dir)
    if not snapshots(spark, path)[0]:
        return latest_per_key(incoming, [trusted.key], trusted.version, [F.desc("dt")])
    stored = read_snapshot(spark, path, trusted.schema)
    return merge_trusted(stored, incoming, trusted, sized(keys, "changed-keys"))


def weather_history(
    spark: SparkSession, base_dir: str, dates: Iterable[str] | DataFrame | Sized | None = None
) -> DataFrame:
    """Complete weather rows of all dates under their trusted names.

    The trusted table keeps one date per city only, so lookups by date read this.
    One row per city and date.
    """
    history = open_table(spark, RAW_WEATHER.path(base_dir), RAW_WEATHER.schema)
    history = on_dates(history, dates)
    complete = with_required(history, RAW_WEATHER.required)
    return to_trusted(complete, RAW_WEATHER, TRUSTED_WEATHER)
