"""Parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.scratch import remove
from tierflow.sources.tables import open_table

# File options of the published tables.
PARQUET = {"compression": "snappy", "parquet.block.size": str(256 * 1024 * 1024)}

SNAPSHOT = "snapshot_id"


def overwrite_partitions(
    df: DataFrame, path: str, partition: str, *, several: bool = True
) -> None:
    """Replace exactly the partitions that ``df`` has rows for; create the table if absent.

    The data may come from the same table.  When ``several`` partitions may be touched the
    rows are rebalanced on the partition column first, which gives each partition files
    of the advisory size (AQE splits a hot one) instead of one file per task.
    """
    if several:
        df = df.hint("rebalance", partition)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PARQUET)
        .partitionBy(partition)
        .parquet(path)
    )


def snapshot_states(spark: SparkSession, path: str) -> dict[int, bool]:
    """Numbers of all snapshots that were begun, and whether each is complete."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    begun = [e.getPath() for e in fs.listStatus(root) if e.getPath().getName().startswith(f"{SNAPSHOT}=")]
    success = spark._jvm.org.apache.hadoop.fs.Path
    return {int(p.getName().removeprefix(f"{SNAPSHOT}=")): fs.exists(success(p, "_SUCCESS")) for p in begun}


def snapshots(spark: SparkSession, path: str) -> tuple[list[int], int]:
    """Ids of the complete snapshots of a table, and the next unused id."""
    states = snapshot_states(spark, path)
    return sorted(n for n, complete in states.items() if complete), max(states, default=0) + 1


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, number: int | None = None
) -> DataFrame:
    """The snapshot of that number, by default the newest complete one, or an empty table if
    none was published."""
    complete, _ = snapshots(spark, path)
    if number is None and not complete:
        return spark.createDataFrame([], schema)
    chosen = complete[-1] if number is None else number
    if chosen not in complete:
        raise ValueError(f"{path} has no complete snapshot {chosen}; there are {complete}")
    return open_table(spark, f"{path}/{SNAPSHOT}={chosen}", schema)


def expire_snapshots(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all but the ``keep`` newest complete snapshots; returns the numbers removed.

    The newest complete snapshot always stays.  Remains of failed writes go if they are
    older than it; a newer one may be a write in progress.
    """
    if keep < 1:
        raise ValueError("the newest complete snapshot cannot be removed")
    states = snapshot_states(spark, path)
    complete = sorted(n for n, done in states.items() if done)
    kept = complete[-keep:]
    gone = sorted(n for n in states if kept and n < kept[-1] and n not in kept)
    for n in gone:
        remove(spark, f"{path}/{SNAPSHOT}={n}")
    return gone


def publish_snapshot(df: DataFrame, path: str) -> int:
    """Replace a whole table: write the next snapshot, which readers see once complete.

    The rows may derive from the current snapshot, which stays untouched; a failed write
    leaves it in force.  One writer per table at a time is assumed.
    """
    _, number = snapshots(df.sparkSession, path)
    (
        df.write.mode("errorifexists")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .options(**PARQUET)
        .parquet(f"{path}/{SNAPSHOT}={number}")
    )
    return number


def quarantine(rejects: DataFrame, path: str, batch_id: str) -> None:
    """Keep rejected rows (``reason``, ``payload``) under their batch.

    Running a batch again replaces its rejects instead of adding to them.
    """
    overwrite_partitions(
        rejects.select("reason", "payload", F.lit(batch_id).alias("batch_id")),
        path, "batch_id", several=False,
    )


def clear_quarantine(spark: SparkSession, path: str, batch_id: str) -> None:
    """Drop what an earlier run of this batch rejected: a mended batch leaves no rejects."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    remove(spark, f"{path}/batch_id={escape(batch_id)}")
