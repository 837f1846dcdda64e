"""Load metrics gathered while a job runs, without a second pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def row_metrics(required: Sequence[str]) -> dict[str, Column]:
    """Row count, and the number of NULLs in each of the given columns."""
    nulls = {f"null_{c}": F.count(F.when(F.col(c).isNull(), 1)) for c in required}
    return {"rows": F.count(F.lit(1)), **nulls}


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Attach metrics to ``df``; read them from the observation after an action.

    A stage that Spark runs again after losing an executor is counted again, so these
    are figures for monitoring; no job takes a decision on an exact value of them.
    """
    observation = Observation()
    return df.observe(observation, *[col.alias(name) for name, col in metrics.items()]), observation
