"""Weather readings, routes and payloads that Spark derives from the driver tables.

``events``: a user is a city and an event a weather reading; it also is a route from the
user's city to the city numbered ``props.k``.  ``orders`` and ``lineitem`` give a larger
set: a customer nation with an order has a weather reading on that date, and every line
is a trip from the supplier's nation to the customer's nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import composite_key, conform, rename_by_position
from tierflow.functions.dates import epoch_to_dt
from tierflow.specs import RAW_WEATHER, TRUSTED_TRAFFIC, TRUSTED_WEATHER

DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(col: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone, whatever the session's zone."""
    days = F.unix_date(col.cast("date")).cast("long")
    return days * DAY + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt evenly: a row group, however large, is read by one task, and
    payloads cost far more to make and parse than the short rows they come from."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"))
    return events.withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "epoch": epoch(F.col("ts")),
        }
    )


def weather_payload(temp: Column, name: Column | None = None) -> Column:
    """Weather API text of an event; NULL fields are absent from the text."""
    if name is None:
        name = F.concat(F.lit("City "), F.col("user_id").cast("string"))
    kind, k, value = F.col("event_type"), F.col("k"), F.col("value")
    return F.to_json(
        F.struct(
            F.col("user_id").alias("id"),
            name.alias("name"),
            F.col("epoch").alias("dt"),
            F.when(kind != "view", k * 100).alias("visibility"),
            F.struct(value.alias("lon"), (-value).alias("lat")).alias("coord"),
            F.array(F.struct(kind.alias("description"))).alias("weather"),
            F.struct(
                temp.alias("temp"),
                (temp + 0.5).alias("feels_like"),
                (temp - 1).alias("temp_min"),
                (temp + 1).alias("temp_max"),
                value.alias("pressure"),
                k.alias("humidity"),
                F.when(kind == "click", k).alias("sea_level"),
            ).alias("main"),
            F.struct(
                (value / 2).alias("speed"),
                k.alias("deg"),
                F.when(kind == "error", value).alias("gust"),
            ).alias("wind"),
            F.struct(
                F.lit("BR").alias("country"),
                (F.col("epoch") - 3600).alias("sunrise"),
                (F.col("epoch") + 3600).alias("sunset"),
            ).alias("sys"),
        )
    )


def event_weather(
    spark: SparkSession, sf_dir: str, *extra: str, name: Column | None = None
) -> DataFrame:
    """One landed weather payload per event, and ``extra`` columns of the event."""
    return keyed_events(spark, sf_dir).select(
        *extra, weather_payload(F.col("value"), name).alias("payload")
    )


def event_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings of type error sent again, same time and city, ten degrees warmer."""
    late = keyed_events(spark, sf_dir).where(F.col("event_type") == "error")
    return late.select("event_id", weather_payload(F.col("value") + 10).alias("payload"))


def directions_payload(
    origin: Column, origin_name: Column, destination: Column, destination_name: Column,
    alternatives: Column, metres: Column, seconds: Column, steps: Column,
) -> Column:
    """Directions API text with the given number of route alternatives and steps."""
    def step(i: Column) -> Column:
        return F.struct(
            F.concat(F.lit("turn "), i.cast("string")).alias("html_instructions"),
            F.struct(
                F.concat(i.cast("string"), F.lit(" km")).alias("text"),
                (i * 1000).alias("value"),
            ).alias("distance"),
        )

    def route(i: Column) -> Column:
        leg = F.struct(
            F.concat(origin_name, F.lit(", BR")).alias("start_address"),
            F.concat(destination_name, F.lit(", BR")).alias("end_address"),
            F.struct(
                F.concat((metres + i).cast("string"), F.lit(" m")).alias("text"),
                (metres + i).alias("value"),
            ).alias("distance"),
            F.struct(
                F.concat((seconds + i).cast("string"), F.lit(" s")).alias("text"),
                (seconds + i).alias("value"),
            ).alias("duration"),
            F.transform(F.sequence(F.lit(1), steps), step).alias("steps"),
        )
        return F.struct(F.array(leg).alias("legs"))

    numbered = F.slice(F.sequence(F.lit(0), alternatives), F.lit(1), alternatives)
    return F.to_json(
        F.struct(
            F.struct(
                F.struct(origin.alias("nu_cidade"), origin_name.alias("cidade")).alias("origin"),
                F.struct(
                    destination.alias("nu_cidade"), destination_name.alias("cidade")
                ).alias("destination"),
            ).alias("route"),
            F.transform(numbered, route).alias("routes"),
        )
    )


def event_routes(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One landed directions payload per event, with two alternatives, and ``extra`` columns."""
    city = lambda c: F.concat(F.lit("City "), F.col(c).cast("string"))
    return keyed_events(spark, sf_dir).select(
        "epoch", *extra,
        directions_payload(
            F.col("user_id").cast("int"), city("user_id"), F.col("k"), city("k"),
            F.lit(2), F.floor("value").cast("int") * 10, F.col("k") * 60,
            F.lit(1) + F.length("event_type"),
        ).alias("payload"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by supplier nation, customer nation, order date and line number."""
    nation = table(spark, sf_dir, "nation")
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    ends = lines.join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    ).join(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        F.col("l_suppkey") == F.col("s_suppkey"),
    )
    grouped = ends.groupBy("s_nationkey", "c_nationkey", "o_orderdate", "l_linenumber").agg(
        F.max("l_quantity").cast("int").alias("quantity"), F.count("*").cast("int").alias("lines")
    )
    origin = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin"))
    destination = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("destination")
    )
    return (
        grouped.join(origin, "s_nationkey")
        .join(destination, "c_nationkey")
        .withColumn("epoch", epoch(F.col("o_orderdate")) + F.col("l_linenumber"))
    )


def trip_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed directions payload per trip: 0 to 6 alternatives, 1 to 7 steps."""
    return trips(spark, sf_dir).select(
        "epoch",
        directions_payload(
            F.col("s_nationkey"), F.col("origin"), F.col("c_nationkey"), F.col("destination"),
            F.col("l_linenumber") - 1, F.col("quantity") * 1000, F.col("lines") * 60,
            F.col("l_linenumber"),
        ).alias("payload"),
    )


def trip_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the shape of trusted routes, with several dates and versions per route."""
    step = lambda i: F.create_map(
        F.lit("instruction"), F.concat(F.lit("turn "), i.cast("string"))
    )
    trip = trips(spark, sf_dir)
    return conform(
        trip.select(
            composite_key(F.col("s_nationkey"), F.col("c_nationkey")).alias("nu_rota"),
            F.col("s_nationkey").alias("nu_cidade_origem"),
            F.col("origin").alias("cidade_origem"),
            F.col("c_nationkey").alias("nu_cidade_destino"),
            F.col("destination").alias("cidade_destino"),
            F.concat("origin", F.lit(", BR")).alias("localizacao_inicial"),
            F.concat("destination", F.lit(", BR")).alias("localizacao_final"),
            F.concat(F.col("quantity").cast("string"), F.lit(" km")).alias("cd_distancia"),
            (F.col("quantity") * 1000).alias("distancia"),
            F.concat(F.col("lines").cast("string"), F.lit(" min")).alias("cd_duracao"),
            (F.col("lines") * 60).alias("duracao"),
            F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), step).alias("passos"),
            F.col("epoch").alias("dt_carga"),
            epoch_to_dt(F.col("epoch")).alias("dt"),
        ),
        TRUSTED_TRAFFIC.schema,
    )


def order_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of raw weather rows: several versions per nation and date."""
    priced = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    price, loaded = F.col("o_totalprice"), epoch(F.col("o_orderdate")) + F.col("o_orderkey") % DAY
    status = F.col("o_orderstatus")
    return conform(
        priced.select(
            F.col("c_nationkey").alias("id"),
            F.col("n_name").alias("city"),
            F.lit("BR").alias("country"),
            F.col("n_nationkey").alias("lon"),
            (-F.col("n_nationkey")).alias("lat"),
            F.col("o_orderpriority").alias("weather_description"),
            (price / 1000).alias("temp"),
            (price / 1000 + 0.5).alias("feels_like"),
            (price / 1000 - 1).alias("temp_min"),
            (price / 1000 + 1).alias("temp_max"),
            F.lit(1000).alias("pressure"),
            F.length("o_orderpriority").alias("humidity"),
            F.when(status == "F", F.col("n_nationkey")).alias("sea_level"),
            F.lit(None).cast("int").alias("grnd_level"),
            F.lit(None).cast("int").alias("visibility"),
            F.col("c_acctbal").alias("wind_speed"),
            F.lit(180).alias("wind_deg"),
            F.lit(None).cast("float").alias("wind_gust"),
            (loaded - 3600).alias("sunrise"),
            (loaded + 3600).alias("sunset"),
            loaded.alias("load_dt"),
            epoch_to_dt(loaded).alias("dt"),
        ),
        RAW_WEATHER.schema,
    )


def as_trusted_weather(readings: DataFrame) -> DataFrame:
    """Raw weather rows under their trusted names."""
    renamed = rename_by_position(readings, RAW_WEATHER.schema, TRUSTED_WEATHER.schema)
    return conform(renamed, TRUSTED_WEATHER.schema)
