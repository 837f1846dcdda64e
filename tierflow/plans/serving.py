"""Publish a table of any zone to a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierflow.sinks.files import read_snapshot
from tierflow.sinks.jdbc import publish_jdbc
from tierflow.sources.tables import open_table
from tierflow.specs import TableSpec


def serving_source(spark: SparkSession, spec: TableSpec, base_dir: str) -> DataFrame:
    """The current rows of a partitioned table or of a table with snapshots."""
    read = open_table if spec.partition else read_snapshot
    return read(spark, spec.path(base_dir), spec.schema)


def publish_table(
    spark: SparkSession,
    spec: TableSpec,
    base_dir: str,
    options: Mapping[str, str],
    mode: str = "overwrite",
) -> None:
    """Scan, encode nested columns, write over JDBC (see ``jdbc_options``)."""
    publish_jdbc(serving_source(spark, spec, base_dir), options, mode)
