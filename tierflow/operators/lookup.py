"""Joins against the weather-by-city-and-date reference.

The reference side is one row per (city, date); the referencing side may be arbitrarily
large and skewed to a few cities.  A reference that is known to be small is broadcast, which
moves no row of the large side; any other is left to Spark, which broadcasts by the sizes it
finds and whose adaptive execution splits the partitions of a hot city.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import composite_key
from tierflow.functions.text import fold
from tierflow.operators.filters import with_required
from tierflow.operators.sizing import Sized, frame, is_small

def attach_twice(
    facts: DataFrame,
    reference: DataFrame,
    key: str,
    date: str,
    roles: Mapping[str, str],
    payload: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``reference`` once per role on (``key``, ``date``).

    ``roles`` maps a suffix to the column of ``facts`` that holds the key in that role;
    the payload columns arrive as ``{column}_{suffix}``.
    """
    joined = facts
    for suffix, role_key in roles.items():
        side = reference.select(
            F.col(key).alias("_key"),
            F.col(date).alias("_date"),
            *[F.col(c).alias(f"{c}_{suffix}") for c in payload],
        )
        matches = (joined[role_key] == side["_key"]) & (joined[date] == side["_date"])
        joined = joined.join(side, matches, how).drop("_key", "_date")
    return joined


def missing_references(
    facts: DataFrame, reference: DataFrame, key: str, date: str, roles: Mapping[str, str],
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Distinct (key, date) pairs used in any role that ``reference`` does not hold.

    The pairs are made distinct before the anti join, so hot keys collapse on the map
    side.  ``names`` maps each role to a name column to be listed as ``name``.
    """
    def pair(role: str) -> Column:
        parts = [F.col(roles[role]).alias(key), F.col(date).alias(date)]
        return F.struct(*parts, *([F.col(names[role]).alias("name")] if names else []))

    used = (
        facts.select(F.explode(F.array(*map(pair, roles))).alias("used"))
        .select("used.*")
        .distinct()
    )
    return used.join(reference.select(key, date), [key, date], "left_anti")


def city_names(cities: DataFrame | Sized) -> DataFrame:
    """One row per folded city name and date.

    ``cities`` has ``nu_cidade``, ``cidade`` and ``dt``.  When several ids share a name,
    ``homonyms`` is true and the id is NULL: minimum and maximum tell them apart, so
    nothing is collected per name.
    """
    low, high = F.min("nu_cidade"), F.max("nu_cidade")
    return (
        with_required(frame(cities), ["nu_cidade", "cidade", "dt"])
        .groupBy(fold(F.col("cidade")).alias("folded"), "dt")
        .agg(
            F.when(low == high, low).alias("nu_cidade"),
            F.when(low == high, F.min("cidade")).alias("cidade"),
            (low != high).alias("homonyms"),
        )
    )


def resolve_city_pairs(requests: DataFrame, cities: DataFrame | Sized) -> DataFrame:
    """Find the ids of the requested origin and destination cities.

    ``requests`` has ``origin``, ``destination`` and ``dt``; names match without regard
    to case and accents, on the same date.  Every request comes back once, with
    ``status`` resolved, missing or ambiguous.
    """
    known = city_names(cities)
    if is_small(cities):  # its names are no more than its rows
        known = F.broadcast(known)
    pairs = requests.withColumns(
        {"_origin": fold(F.col("origin")), "_destination": fold(F.col("destination"))}
    )
    resolved = attach_twice(
        pairs, known, "folded", "dt",
        {"origin": "_origin", "destination": "_destination"},
        ["nu_cidade", "cidade", "homonyms"],
        how="left",
    )
    missing = F.col("homonyms_origin").isNull() | F.col("homonyms_destination").isNull()
    ambiguous = F.col("homonyms_origin") | F.col("homonyms_destination")
    return resolved.select(
        *requests.columns,
        "nu_cidade_origin", "cidade_origin", "nu_cidade_destination", "cidade_destination",
        composite_key(F.col("nu_cidade_origin"), F.col("nu_cidade_destination")).alias("route_uuid"),
        F.when(missing, "missing").when(ambiguous, "ambiguous").otherwise("resolved").alias("status"),
    )
