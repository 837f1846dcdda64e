"""Row filters and the accepted/rejected split."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.sizing import Sized, broadcast_within, sized

#: So many values go into a plan as literals.
LITERALS = 64


def among(df: DataFrame, column: str, values: Iterable | DataFrame | Sized | None) -> DataFrame:
    """Rows whose ``column`` is one of ``values`` (all rows for None); NULL is in no set.

    A few values become literals, which prune partitions while the plan is built.  A table
    of values (its column has the same name), or a long list, which is written as one, is
    met by a left semi join, which prunes partitions while the query runs.
    """
    if values is None:
        return df
    if not isinstance(values, (DataFrame, Sized)):
        known = list(values)
        if len(known) <= LITERALS:
            return df.where(F.col(column).isin(*known))
        schema = T.StructType([df.schema[column]])
        values = sized(df.sparkSession.createDataFrame([(v,) for v in known], schema), "values", keep=True)
    wanted = broadcast_within(values).select(column)
    # Spark prunes by a join only if the small side has a comparison that may select rows.
    return df.join(wanted.where(F.col(column).cast("string") >= ""), column, "left_semi").select(*df.columns)


def on_dates(
    df: DataFrame, dates: Iterable[str] | DataFrame | Sized | None, column: str = "dt"
) -> DataFrame:
    """Rows of the given dates (all rows for None); prunes partitions on ``column``."""
    return among(df, column, dates)


def nothing_in(values: Iterable | DataFrame | Sized | None) -> bool:
    """Whether a given set is known to be empty without running a job."""
    if isinstance(values, Sized):
        return values.rows == 0
    return values is not None and not isinstance(values, DataFrame) and not list(values)


def missing_fields(columns: Sequence[str]) -> Column:
    """Comma-separated names of the columns that are NULL, or NULL if all are filled."""
    absent = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return F.nullif(absent, F.lit(""))


def with_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which every required column is filled."""
    return df.where(all_filled(columns))


def without_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that lack a required column, with the reason and the row as JSON text."""
    return df.where(lacks_any(columns)).select(
        F.concat(F.lit("missing:"), missing_fields(columns)).alias("reason"),
        F.to_json(F.struct("*")).alias("payload"),
    )


def all_filled(columns: Sequence[str]) -> Column:
    """True when no column is NULL.

    A conjunction, unlike ``dropna``'s single expression, reaches the parquet scan and
    stays cheap for the optimizer when many columns are renamed.
    """
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def lacks_any(columns: Sequence[str]) -> Column:
    """True when at least one of the columns is NULL."""
    return reduce(or_, [F.col(c).isNull() for c in columns])
