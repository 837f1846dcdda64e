"""Refined star schema: city, weather and route dimensions, route and step facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import composite_key, conform
from tierflow.functions.dates import epoch_to_date
from tierflow.operators.filters import on_dates, with_required
from tierflow.operators.latest import union_aligned
from tierflow.operators.lookup import attach_twice
from tierflow.operators.sizing import Sized, broadcast_within, sized
from tierflow.plans.enrichment import ROLES
from tierflow.plans.promotion import to_trusted, weather_history
from tierflow.sinks.files import overwrite_partitions, publish_snapshot, read_snapshot
from tierflow.sources.scratch import job_scratch
from tierflow.sources.tables import open_table
from tierflow.specs import (
    CITY_DIM,
    RAW_TRAFFIC,
    ROUTE_DIM,
    ROUTE_FACT,
    STEP_FACT,
    TRUSTED_TRAFFIC,
    TRUSTED_WEATHER,
    WEATHER_DIM,
)


def city_dimension(weather: DataFrame) -> DataFrame:
    """One row per city from a table that has one row per city."""
    return conform(weather, CITY_DIM.schema)


def weather_dimension(readings: DataFrame) -> DataFrame:
    """One row per reading; the key joins the city and the load time."""
    key = composite_key(F.col("nu_cidade"), F.col("dt_carga"))
    return conform(readings.withColumn("nu_clima", key), WEATHER_DIM.schema)


def route_dimension(routes: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """One row per route from a table that has one row per route; epochs become dates."""
    return conform(with_load_date(routes, time_zone), ROUTE_DIM.schema)


def route_fact(routes: DataFrame, climate: DataFrame | Sized) -> DataFrame:
    """One row per route and date with the keys of city, weather and step list.

    A route without a reading at one end keeps a NULL weather key.
    """
    keys = broadcast_within(climate).select("nu_cidade", "dt", "nu_clima")
    joined = attach_twice(
        routes.select("nu_rota", *ROLES.values(), "duracao", "dt"),
        keys, "nu_cidade", "dt", ROLES, ["nu_clima"], how="left",
    )
    return conform(joined.withColumn("nu_passo", step_key()), ROUTE_FACT.schema)


def step_fact(routes: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """One row per route and date with its list of steps."""
    keyed = with_load_date(routes.withColumn("nu_passo", step_key()), time_zone)
    return conform(keyed, STEP_FACT.schema)


def steps(fact: DataFrame) -> DataFrame:
    """The step lists laid out as one row per step, in driving order."""
    return fact.select("nu_passo", F.posexplode("passos").alias("pos", "passo"))


def step_key():
    return composite_key(F.col("nu_rota"), F.col("dt").cast("string"))


def with_load_date(routes: DataFrame, time_zone: str) -> DataFrame:
    return routes.withColumn("dt_carga", epoch_to_date(F.col("dt_carga"), time_zone))


#: Foreign keys of the route fact: column -> dimension and its key.
REFERENCES = {
    "nu_rota": (ROUTE_DIM, "nu_rota"),
    "nu_cidade_origem": (CITY_DIM, "nu_cidade"),
    "nu_cidade_destino": (CITY_DIM, "nu_cidade"),
    "nu_clima_origem": (WEATHER_DIM, "nu_clima"),
    "nu_clima_destino": (WEATHER_DIM, "nu_clima"),
    "nu_passo": (STEP_FACT, "nu_passo"),
}


def orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """(dt, column, dimension, key, rows): fact rows whose key no dimension row has.

    ``dimensions`` holds the tables by name.  One pass lays out all keys of the fact, counts
    equal ones on the map side, and one anti join meets the keys of all dimensions.  A NULL
    key has no dimension row, so it is an orphan.
    """
    used = F.explode(
        F.array(*[
            F.struct(
                F.lit(column).alias("column"), F.lit(spec.name).alias("dimension"),
                F.col(column).cast("string").alias("key"),
            )
            for column, (spec, _) in REFERENCES.items()
        ])
    )
    counted = fact.select("dt", used.alias("_used")).select("dt", "_used.*").groupBy(
        "dt", "column", "dimension", "key"
    ).agg(F.count(F.lit(1)).alias("rows"))
    known = union_aligned(*[
        dimensions[name].select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"))
        for name, key in {(spec.name, key): None for spec, key in REFERENCES.values()}
    ])
    return counted.join(known, ["dimension", "key"], "left_anti").select(
        "dt", "column", "dimension", "key", "rows"
    )


def orphan_path(base_dir: str) -> str:
    return f"{ROUTE_FACT.quarantine_path(base_dir)}_orphans"


def build_star(
    spark: SparkSession,
    base_dir: str,
    *,
    dates: Iterable[str] | DataFrame | Sized | None = None,
    time_zone: str = "UTC",
) -> int:
    """Write the five refined tables and the orphans of the fact; returns their number.

    The dimensions with one row per key follow from the trusted tables without a
    shuffle.  The dated tables replace only the given ``dates`` (all for None); the list of
    orphans covers the dates that this run built.
    """
    if dates is not None and not isinstance(dates, (DataFrame, Sized)):
        dates = list(dates)
    cities = read_snapshot(spark, TRUSTED_WEATHER.path(base_dir), TRUSTED_WEATHER.schema)
    latest_routes = read_snapshot(spark, TRUSTED_TRAFFIC.path(base_dir), TRUSTED_TRAFFIC.schema)
    publish_snapshot(city_dimension(cities), CITY_DIM.path(base_dir))
    publish_snapshot(route_dimension(latest_routes, time_zone), ROUTE_DIM.path(base_dir))

    with job_scratch(spark):
        climate = weather_dimension(weather_history(spark, base_dir, dates))
        overwrite_partitions(climate, WEATHER_DIM.path(base_dir), WEATHER_DIM.partition)
        keys = sized(climate.select("nu_cidade", "dt", "nu_clima"), "climate-keys")
        routes = route_history(spark, base_dir, dates)
        fact = sized(route_fact(routes, keys), "route-fact")
        overwrite_partitions(fact.df, ROUTE_FACT.path(base_dir), ROUTE_FACT.partition)
        lists = step_fact(routes, time_zone)
        overwrite_partitions(lists, STEP_FACT.path(base_dir), STEP_FACT.partition)
        lost = sized(
            orphans(
                fact.df,
                {
                    CITY_DIM.name: read_snapshot(spark, CITY_DIM.path(base_dir), CITY_DIM.schema),
                    ROUTE_DIM.name: read_snapshot(spark, ROUTE_DIM.path(base_dir), ROUTE_DIM.schema),
                    WEATHER_DIM.name: keys.df,
                    STEP_FACT.name: routes.select(step_key().alias("nu_passo")),
                },
            ),
            "orphans",
        )
        publish_snapshot(lost.df, orphan_path(base_dir))
    return lost.rows


def route_history(
    spark: SparkSession, base_dir: str, dates: Iterable[str] | DataFrame | Sized | None = None
) -> DataFrame:
    """Complete routes of all dates under their trusted names, one row per route and date."""
    history = on_dates(
        open_table(spark, RAW_TRAFFIC.path(base_dir), RAW_TRAFFIC.schema), dates
    )
    return to_trusted(with_required(history, RAW_TRAFFIC.required), RAW_TRAFFIC, TRUSTED_TRAFFIC)
