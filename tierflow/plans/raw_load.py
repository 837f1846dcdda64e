"""Load landed payloads into the date-partitioned raw zone."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import NESTED
from tierflow.operators.filters import on_dates
from tierflow.operators.latest import latest_per_key, merge_changed
from tierflow.operators.sizing import Sized, sized
from tierflow.sinks.files import clear_quarantine, overwrite_partitions, quarantine
from tierflow.sources.payloads import RECORDED, TIES, payload_account, route_rows, weather_rows
from tierflow.sources.scratch import job_scratch, staged
from tierflow.sources.tables import open_table, path_exists
from tierflow.specs import RAW_TRAFFIC, RAW_WEATHER, TableSpec

POLICIES = ("fail", "quarantine")


class RejectedRows(ValueError):
    """A strict job met rows it may not skip."""


@dataclass(frozen=True)
class LoadReport:
    """What one load did.

    ``rejected`` counts rows per reason, ``payloads`` landed payloads per outcome (their sum
    is what was landed).  ``dates`` is a written table of the partitions that changed.
    """

    accepted: int
    rejected: dict[str, int]
    payloads: dict[str, int]
    dates: Sized

    @property
    def partitions(self) -> tuple[str, ...]:
        """The changed partitions as values on the driver."""
        return tuple(sorted(row[0] for row in self.dates.df.collect()))


def check_policy(on_error: str) -> None:
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}, not {on_error!r}")


def load_weather(
    landed: DataFrame,
    base_dir: str,
    batch_id: str,
    *,
    payload: str = "payload",
    defaults: bool = True,
    time_zone: str = "UTC",
    on_error: str = "quarantine",
) -> LoadReport:
    """Parse current-weather payloads and upsert them by (city, date)."""
    rows = weather_rows(landed, payload=payload, defaults=defaults, time_zone=time_zone)
    return load_rows(rows, RAW_WEATHER, base_dir, batch_id, on_error)


def load_routes(
    landed: DataFrame,
    base_dir: str,
    batch_id: str,
    load_ts: Column | int,
    *,
    payload: str = "payload",
    time_zone: str = "UTC",
    on_error: str = "fail",
) -> LoadReport:
    """Parse directions payloads and upsert their routes by (route, date)."""
    rows = route_rows(landed, load_ts, payload=payload, time_zone=time_zone)
    return load_rows(rows, RAW_TRAFFIC, base_dir, batch_id, on_error)


def load_rows(
    rows: DataFrame, spec: TableSpec, base_dir: str, batch_id: str, on_error: str
) -> LoadReport:
    """Split parsed rows into upserted and quarantined ones.

    Parsing is the expensive part, so its result is written once and scanned for the
    counts, the account, the merge and the quarantine; it is removed at the end.
    """
    check_policy(on_error)
    spark = rows.sparkSession
    with job_scratch(spark):
        batch = staged(rows, f"load-{spec.name}")
        good = batch.where(F.col("_reason").isNull())
        rejected = {
            row["_reason"]: row["count"]
            for row in batch.where(F.col("_reason").isNotNull()).groupBy("_reason").count().collect()
        }
        if on_error == "fail" and any(reason not in RECORDED for reason in rejected):
            raise RejectedRows(f"{spec.name}: rejected rows by reason: {rejected}")
        if rejected:
            rejects = batch.where(F.col("_reason").isNotNull())
            quarantine(
                rejects.select(F.col("_reason").alias("reason"), F.col("_payload").alias("payload")),
                spec.quarantine_path(base_dir), batch_id,
            )
        else:
            clear_quarantine(spark, spec.quarantine_path(base_dir), batch_id)
        account = payload_account(batch).withColumn("batch_id", F.lit(batch_id))
        overwrite_partitions(account, account_path(spec, base_dir), "batch_id", several=False)
        per_date = good.groupBy(spec.partition).agg(F.count(F.lit(1)).alias("n"))
        touched = sized(per_date, "dates", keep=True)
        accepted = touched.df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        dates = replace(touched, df=touched.df.select(spec.partition))
        payloads = {}
        if dates.rows or rejected:  # without a row nothing was written
            written = open_table(spark, account_path(spec, base_dir), account.schema)
            own = written.where(F.coalesce("batch_id", F.lit("")) == batch_id)
            payloads = {
                row["outcome"]: row["n"]
                for row in own.groupBy("outcome").agg(F.sum("payloads").alias("n")).collect()
            }
        if dates.rows:
            upsert_partitions(good.select(*spec.schema.names, *TIES), spec, base_dir, dates)
    return LoadReport(accepted, rejected, payloads, dates)


def account_path(spec: TableSpec, base_dir: str) -> str:
    """Where the account of all landed payloads is kept, by batch."""
    return f"{spec.quarantine_path(base_dir)}_account"


def upsert_partitions(
    incoming: DataFrame, spec: TableSpec, base_dir: str, dates: Sized | DataFrame
) -> None:
    """Merge rows into the partitions they belong to; other partitions are not read.

    Both the key and the partition identify a row.  Running the same batch again gives
    the same table.
    """
    keys = [spec.partition, spec.key]
    ties = row_order(incoming, spec)
    if path_exists(incoming.sparkSession, spec.path(base_dir)):
        stored = stored_partitions(incoming.sparkSession, spec, base_dir, dates)
        changed = sized(incoming.select(*keys).distinct(), "changed-keys")
        merged = merge_changed(stored, incoming, keys, spec.version, ties, changed)
    else:  # a first load meets no rows
        merged = latest_per_key(incoming, keys, spec.version, ties).select(*spec.schema.names)
    one = isinstance(dates, Sized) and dates.rows == 1
    overwrite_partitions(merged, spec.path(base_dir), spec.partition, several=not one)


def row_order(incoming: DataFrame, spec: TableSpec) -> list[Column]:
    """Total order of rows of equal version: the first route alternative, then the values of
    all columns in order, then the digest of the payload."""
    same = (spec.key, spec.version, spec.partition)
    plain = [f.name for f in spec.schema.fields if not isinstance(f.dataType, NESTED) and f.name not in same]
    helpers = [c for c in TIES if c in incoming.columns]
    return [F.asc(c) for c in (*helpers[:1], *plain, *helpers[1:])]


def stored_partitions(
    spark: SparkSession, spec: TableSpec, base_dir: str, dates: Iterable[str] | DataFrame | Sized
) -> DataFrame:
    table = open_table(spark, spec.path(base_dir), spec.schema)
    return on_dates(table, dates, spec.partition)
