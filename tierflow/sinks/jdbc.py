"""Publication of a table to a relational database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tierflow.functions.columns import nested_to_json

MODES = ("append", "overwrite")


def jdbc_options(
    url: str,
    schema: str,
    table: str,
    *,
    driver: str = "org.postgresql.Driver",
    connections: int = 16,
    batch_rows: int = 10_000,
    keep_definition: bool = True,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Writer options: at most ``connections`` tasks write at once, in row batches.

    ``keep_definition`` makes an overwrite truncate the target, so that its column types,
    indexes and grants stay.  Credentials come in ``properties``.
    """
    return {
        **(properties or {}),
        "url": url,
        "dbtable": f"{schema}.{table}",
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        "truncate": str(keep_definition).lower(),
    }


def publish_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "overwrite") -> None:
    """Write ``df`` with every nested column encoded as JSON text."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    nested_to_json(df).write.format("jdbc").options(**options).mode(mode).save()
