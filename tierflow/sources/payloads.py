"""Landed API responses (one JSON text per row) to typed raw rows.

Both parsers return the raw table's columns plus

* ``_reason``: why the row is rejected, NULL for accepted rows,
* ``_payload``: the original text of a rejected row,
* ``_position``, ``_digest``: total order of rows that share key and version.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.columns import composite_key, first, whole
from tierflow.functions.dates import epoch_to_dt
from tierflow.specs import (
    DIRECTIONS_PAYLOAD, NUMBER, RAW_TRAFFIC, RAW_WEATHER, WEATHER_PAYLOAD, TableSpec,
)

CORRUPT = "_corrupt_record"
TIES = ("_position", "_digest")
WHOLE_BITS = {T.IntegerType(): 32, T.LongType(): 64}
#: From here on a double becomes infinite as a 32-bit float.
FLOAT_END = float(2**128 - 2**103)
CORRUPTED, NO_ROUTES = "corrupt", "no_routes"
#: Reasons that are put on record but do not stop a strict load: nothing in them is lost.
RECORDED = (NO_ROUTES,)
HELPERS = ("_reason", "_payload", *TIES)


def parsed(landed: DataFrame, fields: str, payload: str) -> DataFrame:
    """``landed`` plus the parsed payload ``r``, its text and digest, and

    * ``_unreadable``: the text is empty, is not JSON, or has a value of the wrong type,
    * ``_too_large``: it is readable but for a number beyond its decimal type.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def read(schema: str) -> Column:
        return F.from_json(payload, f"{schema}, {CORRUPT} string", options)

    texts = landed.withColumns({"_text": F.col(payload), "_digest": F.xxhash64(payload), "r": read(fields)})
    corrupt = F.col(f"r.{CORRUPT}").isNotNull()
    if NUMBER in fields:  # a second look, at failed texts only
        wider = read(fields.replace(NUMBER, "double")).getField(CORRUPT)
        texts = texts.withColumn("_too_large", F.when(corrupt, wider.isNull()).otherwise(F.lit(False)))
    else:
        texts = texts.withColumn("_too_large", F.lit(False))
    return texts.withColumn("_unreadable", F.col("r").isNull() | (corrupt & ~F.col("_too_large")))


def weather_rows(
    landed: DataFrame, *, payload: str = "payload", defaults: bool = True, time_zone: str = "UTC"
) -> DataFrame:
    """Current-weather payloads to raw weather rows.

    ``defaults`` writes 0 for an absent required number; without it the number stays
    NULL and the row is stopped at promotion.  ``dt`` is the date of the reading.
    """
    def number(path: str, default: bool = defaults) -> Column:
        value = F.col(f"r.{path}")
        return F.coalesce(value, F.lit(0)) if default else value

    values = {
        "id": F.col("r.id"),
        "city": F.col("r.name"),
        "country": F.col("r.sys.country"),
        "lon": number("coord.lon"),
        "lat": number("coord.lat"),
        "weather_description": first(F.col("r.weather")).getField("description"),
        "temp": number("main.temp"),
        "feels_like": number("main.feels_like"),
        "temp_min": number("main.temp_min"),
        "temp_max": number("main.temp_max"),
        "pressure": number("main.pressure"),
        "humidity": number("main.humidity"),
        "sea_level": number("main.sea_level", False),
        "grnd_level": number("main.grnd_level", False),
        "visibility": number("visibility"),
        "wind_speed": number("wind.speed"),
        "wind_deg": number("wind.deg"),
        "wind_gust": number("wind.gust", False),
        "sunrise": number("sys.sunrise"),
        "sunset": number("sys.sunset"),
        "load_dt": F.col("r.dt"),
        "dt": epoch_to_dt(whole(F.col("r.dt"), T.LongType()), time_zone),
    }
    rows = parsed(landed, WEATHER_PAYLOAD, payload).withColumn("_position", F.lit(0))
    return raw_rows(rows, RAW_WEATHER, values)


def route_rows(
    landed: DataFrame, load_ts: Column | int, *, payload: str = "payload", time_zone: str = "UTC"
) -> DataFrame:
    """Directions payloads to raw traffic rows, one per route alternative.

    ``load_ts`` is the load time in epoch seconds, a constant or a column of ``landed``.
    A readable payload without routes, such as an error body, yields one row with the reason
    ``no_routes``.
    """
    loaded = F.lit(load_ts) if isinstance(load_ts, int) else load_ts
    exploded = (
        parsed(landed.withColumn("_loaded", loaded.cast("long")), DIRECTIONS_PAYLOAD, payload)
        .select(
            "_text", "_digest", "_unreadable", "_too_large", "_loaded",
            F.col("r.route.origin").alias("_from"),
            F.col("r.route.destination").alias("_to"),
            F.col("r.routes").alias("_routes"),
        )
        .select("*", F.posexplode_outer("_routes").alias("_position", "_route"))
        .withColumn("_leg", first(F.col("_route.legs")))
    )
    values = {
        "route_uuid": composite_key(F.col("_from.nu_cidade"), F.col("_to.nu_cidade")),
        "origin_uuid": F.col("_from.nu_cidade"),
        "origin_city": F.col("_from.cidade"),
        "destination_uuid": F.col("_to.nu_cidade"),
        "destination_city": F.col("_to.cidade"),
        "destination_start": F.col("_leg.start_address"),
        "destination_end": F.col("_leg.end_address"),
        "cd_travel_distance": F.col("_leg.distance.text"),
        "travel_distance": F.col("_leg.distance.value"),
        "cd_travel_duration": F.col("_leg.duration.text"),
        "travel_duration": F.col("_leg.duration.value"),
        "steps": F.col("_leg.steps"),
        "load_dt": F.col("_loaded"),
        "dt": epoch_to_dt(F.col("_loaded"), time_zone),
    }
    return raw_rows(exploded, RAW_TRAFFIC, values, absent=NO_ROUTES)


def payload_account(rows: DataFrame) -> DataFrame:
    """(digest, payloads, accepted, rejected, outcome): what became of each landed payload.

    ``payloads`` counts how often the text was landed, the next two its rows.  The outcome is
    ``accepted``, ``partly`` accepted, or the (first) reason of a payload without accepted rows.
    """
    first_row = F.coalesce(F.col("_position"), F.lit(0)) == 0
    counted = rows.groupBy(F.col("_digest").alias("digest")).agg(
        F.count_if(first_row).alias("payloads"),
        F.count_if(F.col("_reason").isNull()).alias("accepted"),
        F.count_if(F.col("_reason").isNotNull()).alias("rejected"),
        F.min("_reason").alias("_reason"),
    )
    outcome = (
        F.when(F.col("rejected") == 0, "accepted").when(F.col("accepted") > 0, "partly").otherwise(F.col("_reason"))
    )
    return counted.withColumn("outcome", outcome).drop("_reason")


def raw_rows(
    df: DataFrame, spec: TableSpec, values: Mapping[str, Column], absent: str = "absent"
) -> DataFrame:
    """Cast extracted values to the raw schema and give each unusable row a reason.

    ``absent`` is the reason of a payload that holds no row at all (no ``_position``).
    Each step refers to the columns of the one before, so nothing is computed twice.
    """
    typed = df.select(
        *[whole(values[f.name], f.dataType).alias(f.name) for f in spec.schema.fields],
        (F.col("_too_large") | overflow(df, spec, values)).alias("_overflow"),
        "_unreadable", "_text", *TIES,
    )
    reason = (
        F.when(F.col("_unreadable"), CORRUPTED)
        .when(F.col("_overflow"), "out_of_range")
        .when(F.col("_position").isNull(), absent)
        .when(F.col(spec.key).isNull(), f"null_{spec.key}")
        .when(F.col(spec.partition).isNull(), f"null_{spec.partition}")
    )
    judged = typed.withColumn("_reason", reason)
    kept = F.when(F.col("_reason").isNotNull(), F.col("_text"))
    return judged.select(*spec.schema.names, "_reason", kept.alias("_payload"), *TIES)


def overflow(df: DataFrame, spec: TableSpec, values: Mapping[str, Column]) -> Column:
    """True when a JSON number does not fit the column it is meant for.

    Whole numbers come as decimals, so the bounds are exact: the fraction is cut off, and
    what is left must lie in the range of the type.
    """
    extracted = df.select(*[values[c].alias(c) for c in spec.schema.names]).schema
    exceeds = F.lit(False)
    for field in spec.schema.fields:
        value, given = values[field.name], extracted[field.name].dataType
        if isinstance(given, T.DecimalType) and field.dataType in WHOLE_BITS:
            bound = 1 << (WHOLE_BITS[field.dataType] - 1)
            over = (value >= F.lit(Decimal(bound))) | (value <= F.lit(Decimal(-bound - 1)))
        elif given == T.DoubleType() and field.dataType == T.FloatType():
            over = F.abs(value) >= FLOAT_END
        else:
            continue
        exceeds = exceeds | F.coalesce(over, F.lit(False))
    return exceeds
