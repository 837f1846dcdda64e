"""Scans of parquet tables with a declared schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.functions.columns import conform


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty table of the same schema if there is none.

    Partition values are read with their declared type, so a string ``dt`` stays a
    string and still prunes directories.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def open_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Scan files whose columns differ, with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def typed_rows(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A small table from driver rows, checked against ``schema``."""
    return spark.createDataFrame(list(rows), schema)


def typed_frame(df: DataFrame, schema: T.StructType, *, lenient: bool = False) -> DataFrame:
    """A table of the declared schema from any frame that has its columns."""
    return conform(df, schema, lenient=lenient)
