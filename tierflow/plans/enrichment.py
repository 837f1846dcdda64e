"""Describe each route with the weather at its two ends."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import conform
from tierflow.operators.changes import changed_keys
from tierflow.operators.filters import on_dates
from tierflow.operators.lookup import attach_twice, missing_references
from tierflow.operators.sizing import Sized, broadcast_within, sized
from tierflow.plans.promotion import merge_snapshot, weather_history
from tierflow.plans.raw_load import check_policy
from tierflow.sinks.files import (
    clear_quarantine, overwrite_partitions, publish_snapshot, quarantine, read_snapshot,
    snapshots,
)
from tierflow.sources.scratch import job_scratch, staged
from tierflow.specs import ROUTE_DESCRIPTION, TRUSTED_TRAFFIC

ROLES = {"origem": "nu_cidade_origem", "destino": "nu_cidade_destino"}
ROLE_NAMES = {"origem": "cidade_origem", "destino": "cidade_destino"}
NAMED_IN_ERROR = 20

# Weather column -> stem of its column in the route description.
WEATHER_STEMS = {
    "descricao_tempo": "descricao_tempo",
    "temperatura": "temp",
    "sensacao_termica": "sensacao_termica",
    "temperatura_minima": "temp_minima",
    "temperatura_maxima": "temp_max",
    "nivel_do_mar": "altitude",
}

# Route column -> column of the route description.
ROUTE_NAMES = {
    "nu_cidade_origem": "nu_origem",
    "cidade_origem": "origem",
    "localizacao_inicial": "ponto_partida",
    "nu_cidade_destino": "nu_destino",
    "cidade_destino": "destino",
    "localizacao_final": "ponto_chegada",
}


class MissingWeather(ValueError):
    """Routes refer to cities without weather on their date."""


@dataclass(frozen=True)
class Enrichment:
    """The published snapshot, the number of cities without weather on some date, the
    snapshot of routes that is covered now, and the number of routes that were described."""

    snapshot: int
    missing: int
    routes: int
    described: int


def enrich_routes(routes: DataFrame, weather: DataFrame | Sized, load_ts: int) -> DataFrame:
    """Routes joined with the weather of origin and destination on the route's date.

    Routes without weather at both ends are left out; ``missing_references`` finds them.
    """
    slim = broadcast_within(weather).select("nu_cidade", "dt", *WEATHER_STEMS)
    joined = attach_twice(routes, slim, "nu_cidade", "dt", ROLES, list(WEATHER_STEMS))
    weather_names = {
        f"{column}_{role}": f"{stem}_{role}"
        for column, stem in WEATHER_STEMS.items()
        for role in ROLES
    }
    described = joined.withColumnsRenamed({**ROUTE_NAMES, **weather_names})
    loaded = described.withColumn("dt_carga", F.lit(load_ts).cast("long"))
    return conform(loaded, ROUTE_DESCRIPTION.schema)


def routes_to_describe(
    spark: SparkSession, base_dir: str, routes: DataFrame, since: int | None,
    weather_dates: Iterable[str] | DataFrame | Sized = (),
) -> DataFrame:
    """The trusted routes whose description may differ from what was described before.

    These are the routes that were added or changed after the snapshot ``since``, and those
    on ``weather_dates``, for which weather arrived meanwhile.  Without ``since``, or if that
    snapshot has expired, they are all routes.
    """
    path = TRUSTED_TRAFFIC.path(base_dir)
    if since is None or since not in snapshots(spark, path)[0]:
        return routes
    before = read_snapshot(spark, path, TRUSTED_TRAFFIC.schema, since)
    feed = changed_keys(before, routes, TRUSTED_TRAFFIC.key, TRUSTED_TRAFFIC.version)
    late = on_dates(routes, weather_dates)
    keys = feed.select(TRUSTED_TRAFFIC.key).unionByName(late.select(TRUSTED_TRAFFIC.key)).distinct()
    wanted = broadcast_within(sized(keys, "routes-to-describe"))
    return routes.join(wanted, TRUSTED_TRAFFIC.key, "left_semi").select(*routes.columns)


def describe_routes(
    spark: SparkSession,
    base_dir: str,
    batch_id: str,
    load_ts: int,
    *,
    on_missing: str = "fail",
    since: int | None = None,
    weather_dates: Iterable[str] | DataFrame | Sized = (),
) -> Enrichment:
    """Enrich trusted routes, merge them into the route descriptions and publish.

    By default all routes are described.  A later run may pass the ``routes`` snapshot of the
    run before as ``since`` and the dates of weather loads in between as ``weather_dates``:
    then only routes that these touch are joined, and weather of no other date is read.  The
    table is that of a full run, but untouched routes keep their earlier load time.

    ``on_missing`` either stops the job with the cities that lack weather, or sets the
    routes that need them aside.
    """
    check_policy(on_missing)
    source = TRUSTED_TRAFFIC.path(base_dir)
    complete, _ = snapshots(spark, source)
    newest = read_snapshot(spark, source, TRUSTED_TRAFFIC.schema)
    path = ROUTE_DESCRIPTION.path(base_dir)
    with job_scratch(spark):
        routes = routes_to_describe(spark, base_dir, newest, since, weather_dates)
        if routes is not newest:  # a snapshot is written already
            routes = staged(routes, "routes")
        described = routes.count()
        dates = sized(routes.select("dt").distinct(), "route-dates")
        history = weather_history(spark, base_dir, dates)
        weather = sized(history.select("nu_cidade", "dt", *WEATHER_STEMS), "weather")
        count = set_aside(routes, weather, base_dir, batch_id, on_missing)
        incoming = enrich_routes(routes, weather, load_ts)
        keys = routes.select(ROUTE_DESCRIPTION.key)
        merged = merge_snapshot(spark, base_dir, incoming, ROUTE_DESCRIPTION, keys)
        number = publish_snapshot(merged, path)
    return Enrichment(number, count, complete[-1] if complete else 0, described)


def set_aside(
    routes: DataFrame, weather: Sized, base_dir: str, batch_id: str, on_missing: str
) -> int:
    """List the cities without weather and quarantine the routes that need them, or stop.

    Returns the number of such cities.
    """
    spark = routes.sparkSession
    # one row per city and date, however its name is spelled
    missing = sized(
        missing_references(routes, weather.df, "nu_cidade", "dt", ROLES, ROLE_NAMES)
        .groupBy("nu_cidade", "dt").agg(F.min("name").alias("name")),
        "missing",
    )
    quarantined = ROUTE_DESCRIPTION.quarantine_path(base_dir)
    listing = f"{quarantined}_missing"
    if not missing.rows:
        clear_quarantine(spark, listing, batch_id)
        clear_quarantine(spark, quarantined, batch_id)
        return 0
    count = missing.df.select("nu_cidade").distinct().count()
    overwrite_partitions(
        missing.df.withColumn("batch_id", F.lit(batch_id)), listing, "batch_id", several=False
    )
    if on_missing == "fail":
        named = ", ".join(f"{r['name']} ({r['dt']})" for r in missing.df.take(NAMED_IN_ERROR))
        raise MissingWeather(
            f"{count} cities without weather, load them first; all of them are listed in "
            f"{listing}, batch_id={batch_id}, among them: {named}"
        )
    quarantine(routes_without_weather(routes, missing), quarantined, batch_id)
    return count


def routes_without_weather(routes: DataFrame, missing: Sized) -> DataFrame:
    """Routes with a missing end: the reason names the roles, the payload is the row."""
    lost = broadcast_within(missing).select("nu_cidade", "dt", F.lit(True).alias("lost"))
    marked = attach_twice(routes, lost, "nu_cidade", "dt", ROLES, ["lost"], how="left")
    roles = F.concat_ws(
        ",", *[F.when(F.col(f"lost_{role}"), F.lit(role)) for role in ROLES]
    )
    return marked.where(F.coalesce(*[F.col(f"lost_{role}") for role in ROLES])).select(
        F.concat(F.lit("no_weather:"), roles).alias("reason"),
        F.to_json(F.struct(*routes.columns)).alias("payload"),
    )
