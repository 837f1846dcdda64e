"""Intermediate results as written tables.

Reusing a written table cuts lineage and survives the loss of executors, which cached
blocks do not.  Everything goes to the folder that the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths that the job in progress has staged and will remove.
_OWN: ContextVar[list[str] | None] = ContextVar("own", default=None)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared checkpoint folder.

    Only a local session without the setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tierflow-")
    return f"{shared.rstrip('/')}/tierflow/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str, *, keep: bool = False) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Inside ``job_scratch`` the table goes when the job ends, unless it is to be kept.
    """
    path = scratch_path(df.sparkSession, purpose)
    own = _OWN.get()
    if own is not None and not keep:
        own.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside when the job ends, whether it succeeded or not."""
    own: list[str] = []
    token = _OWN.set(own)
    try:
        yield
    finally:
        _OWN.reset(token)
        for path in own:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
