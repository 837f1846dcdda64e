"""Turn requested city pairs into route requests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.lookup import resolve_city_pairs
from tierflow.operators.sizing import sized
from tierflow.plans.promotion import weather_history
from tierflow.plans.raw_load import check_policy
from tierflow.sinks.files import clear_quarantine, overwrite_partitions, quarantine
from tierflow.sources.scratch import job_scratch, staged
from tierflow.specs import ROUTE_REQUEST

#: Columns of a resolved pair -> columns of a request.
NAMES = {
    "nu_cidade_origin": "origin_uuid", "cidade_origin": "origin_city",
    "nu_cidade_destination": "destination_uuid", "cidade_destination": "destination_city",
}


class UnresolvedCities(ValueError):
    """Requests name cities without weather on their date, or shared by several cities."""


@dataclass(frozen=True)
class Requested:
    """Numbers of requested pairs by status: resolved, missing, ambiguous."""

    statuses: dict[str, int]


def request_routes(
    requests: DataFrame, base_dir: str, batch_id: str, *, on_error: str = "fail"
) -> Requested:
    """Resolve (``origin``, ``destination``, ``dt``) by name and write the requests of a batch.

    Cities are those with complete weather on the date.  A pair that is asked for twice is
    one request.  Pairs that name an unknown or an ambiguous city stop the job and are listed
    in the quarantine, or (``on_error="quarantine"``) are only listed.  Running a batch again
    replaces its requests and its list.
    """
    check_policy(on_error)
    spark = requests.sparkSession
    with job_scratch(spark):
        pairs = requests.select("origin", "destination", "dt").distinct()
        dates = sized(pairs.select("dt").distinct(), "request-dates")
        history = weather_history(spark, base_dir, dates)
        cities = sized(history.select("nu_cidade", "cidade", "dt"), "cities")
        resolved = staged(resolve_city_pairs(pairs, cities), "resolved")
        statuses = {r["status"]: r["count"] for r in resolved.groupBy("status").count().collect()}
        listed = ROUTE_REQUEST.quarantine_path(base_dir)
        lost = sum(n for status, n in statuses.items() if status != "resolved")
        if lost:
            rejects = resolved.where(F.col("status") != "resolved")
            quarantine(
                rejects.select(
                    F.col("status").alias("reason"),
                    F.to_json(F.struct("origin", "destination", "dt")).alias("payload"),
                ),
                listed, batch_id,
            )
        else:
            clear_quarantine(spark, listed, batch_id)
        if lost and on_error == "fail":
            raise UnresolvedCities(
                f"{lost} requests name unknown or ambiguous cities: {statuses}; all of them are "
                f"listed in {listed}, batch_id={batch_id}"
            )
        found = resolved.where(F.col("status") == "resolved").withColumnsRenamed(NAMES)
        wanted = found.select(*ROUTE_REQUEST.schema.names).distinct()
        overwrite_partitions(
            wanted.withColumn("batch_id", F.lit(batch_id)), ROUTE_REQUEST.path(base_dir), "batch_id",
            several=False,
        )
        if not statuses.get("resolved"):  # an empty write replaces no partition
            clear_quarantine(spark, ROUTE_REQUEST.path(base_dir), batch_id)
    return Requested(statuses)
