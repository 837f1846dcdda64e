"""Correctness queries: each runs library operators over whole driver tables, next to SQL
that computes the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.columns import (
    composite_key,
    first,
    nested_to_json,
    rename_by_position,
    whole,
)
from tierflow.functions.dates import epoch_to_dt
from tierflow.functions.text import fold
from tierflow.operators.filters import among, on_dates, with_required
from tierflow.operators.latest import latest_per_key, merge_latest, union_aligned
from tierflow.operators.lookup import missing_references, resolve_city_pairs
from tierflow.operators.metrics import observed, row_metrics
from tierflow.operators.sizing import sized
from tierflow.plans import star
from tierflow.plans.enrichment import ROLES, describe_routes, enrich_routes
from tierflow.plans.promotion import promote_routes, promote_weather
from tierflow.plans.raw_load import account_path, load_routes, load_weather
from tierflow.plans.requests import request_routes
from tierflow.sinks.files import overwrite_partitions, read_snapshot
from tierflow.sources.payloads import route_rows, weather_rows
from tierflow.sources.scratch import scratch_path
from tierflow.sources.tables import open_merged, open_table, typed_frame
from tierflow.specs import (
    RAW_TRAFFIC,
    RAW_WEATHER,
    ROUTE_DESCRIPTION,
    ROUTE_FACT,
    ROUTE_REQUEST,
    STEP_FACT,
    TRUSTED_WEATHER,
    struct,
)
from tierflow.workload import standins
from tierflow.workload.standins import epoch, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LOAD_TS = 1_735_689_600  # load time passed by the caller of a job

# Shared SQL: the derivations of tierflow.workload.standins.
EVENTS_SQL = """
events_k as (
    select *, cast(json_extract_string(props, '$.k') as int) as k,
           cast(floor(epoch(ts)) as bigint) as e, strftime(ts, '%Y-%m-%d') as dt
    from events
)"""
TRIPS_SQL = """
trips as (
    select s_nationkey as o, c_nationkey as d, o_orderdate, l_linenumber as line,
           cast(max(l_quantity) as int) as quantity, cast(count(*) as int) as lines
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey
    group by all
),
routes as (
    select o || '_' || d as nu_rota, o as nu_cidade_origem, a.n_name as cidade_origem,
           d as nu_cidade_destino, b.n_name as cidade_destino, quantity, lines, line,
           cast(epoch(o_orderdate) as bigint) + line as dt_carga,
           strftime(o_orderdate, '%Y-%m-%d') as dt
    from trips join nation a on o = a.n_nationkey join nation b on d = b.n_nationkey
)"""
READINGS_SQL = """
readings as (
    select c_nationkey as id, n_name as city, o_orderpriority as description,
           o_totalprice / 1000 as temp, o_orderstatus as status, c_acctbal as acctbal,
           cast(epoch(o_orderdate) as bigint) + o_orderkey % 86400 as load_dt,
           strftime(o_orderdate, '%Y-%m-%d') as dt
    from orders join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
),
weather as (
    select * from readings
    qualify row_number() over (
        partition by id, dt
        order by load_dt desc, description, cast(temp as float), cast(acctbal as float), status
    ) = 1
)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def doubles(df: DataFrame) -> DataFrame:
    """Widen 32-bit floats, so that results compare with SQL value by value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FloatType)]
    return df.withColumns({c: F.col(c).cast("double") for c in floats}) if floats else df


# --- Scans and sources ------------------------------------------------------------


@query("q01_parquet_scan", "select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders")
def q01(spark, sf):
    schema = table(spark, sf, "orders").schema
    orders = open_table(spark, f"{sf}/orders.parquet", schema)
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query(
    "q02_partition_pruned_scan",
    """select event_id, user_id, value, strftime(ts, '%Y-%m-%d') as dt from events
       where cast(ts as date) = date '2024-01-15'""",
)
def q02(spark, sf):
    path = scratch_path(spark, "q02")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    overwrite_partitions(events, path, "dt")
    return on_dates(open_table(spark, path, events.schema), ["2024-01-15"])


@query(
    "q03_merged_schema_scan",
    """select o_orderkey, o_totalprice, null as o_orderpriority from orders where o_orderstatus = 'F'
       union all by name
       select o_orderkey, o_orderpriority from orders where o_orderstatus <> 'F'""",
)
def q03(spark, sf):
    path = scratch_path(spark, "q03")
    orders = table(spark, sf, "orders")
    finished = F.col("o_orderstatus") == "F"
    orders.where(finished).select("o_orderkey", "o_totalprice").write.parquet(f"{path}/part=a")
    orders.where(~finished).select("o_orderkey", "o_orderpriority").write.parquet(f"{path}/part=b")
    return open_merged(spark, path).drop("part")


@query(
    "q04_conform_to_schema",
    """select cast(c_custkey as int) as nu_cidade, c_name as cidade, c_mktsegment as pais,
              cast(cast(c_acctbal as float) as double) as longitude,
              cast(c_nationkey as bigint) as dt_carga from customer""",
)
def q04(spark, sf):
    schema = struct(
        ("nu_cidade", T.IntegerType()), ("cidade", T.StringType()), ("pais", T.StringType()),
        ("longitude", T.FloatType()), ("dt_carga", T.LongType()),
    )
    customer = table(spark, sf, "customer").withColumnsRenamed(
        {"c_custkey": "nu_cidade", "c_name": "cidade", "c_mktsegment": "pais",
         "c_acctbal": "longitude", "c_nationkey": "dt_carga"}
    )
    return doubles(typed_frame(customer, schema))


WEATHER_ROWS_SQL = """
    select cast(user_id as int) as id, 'City ' || user_id as city, 'BR' as country,
           cast(cast(value as float) as double) as lon,
           cast(cast(-value as float) as double) as lat,
           event_type as weather_description,
           cast(cast(value as float) as double) as temp,
           cast(cast(value + 0.5 as float) as double) as feels_like,
           cast(cast(value - 1 as float) as double) as temp_min,
           cast(cast(value + 1 as float) as double) as temp_max,
           cast(trunc(value) as int) as pressure, k as humidity,
           case when event_type = 'click' then k end as sea_level,
           cast(null as int) as grnd_level,
           case when event_type <> 'view' then k * 100 else 0 end as visibility,
           cast(cast(value / 2 as float) as double) as wind_speed, k as wind_deg,
           case when event_type = 'error' then cast(cast(value as float) as double) end as wind_gust,
           e - 3600 as sunrise, e + 3600 as sunset, e as load_dt, dt, cast(null as varchar) as reason
    from events_k"""


@query("q05_weather_payloads", f"with {EVENTS_SQL} {WEATHER_ROWS_SQL}")
def q05(spark, sf):
    rows = weather_rows(standins.event_weather(spark, sf))
    return doubles(rows.select(*RAW_WEATHER.schema.names, F.col("_reason").alias("reason")))


@query(
    "q06_directions_payloads",
    f"""with {TRIPS_SQL},
    parsed as (
        select *, unnest(case when line = 1 then [null] else range(line - 1) end) as i from routes
    )
    select nu_rota as route_uuid, nu_cidade_origem as origin_uuid, cidade_origem as origin_city,
           nu_cidade_destino as destination_uuid, cidade_destino as destination_city,
           case when line > 1 then cidade_origem || ', BR' end as destination_start,
           case when line > 1 then cidade_destino || ', BR' end as destination_end,
           (quantity * 1000 + i) || ' m' as cd_travel_distance,
           cast(quantity * 1000 + i as int) as travel_distance,
           (lines * 60 + i) || ' s' as cd_travel_duration,
           cast(lines * 60 + i as int) as travel_duration,
           case when line > 1 then cast(line as int) end as n_steps,
           case when line > 1 then 'turn 1' end as first_instruction,
           case when line > 1 then '{{"text":"' || line || ' km","value":' || (line * 1000) || '}}' end
               as last_distance,
           dt_carga as load_dt, dt, cast(i as int) as position,
           case when line = 1 then 'no_routes' end as reason
    from parsed""",
)
def q06(spark, sf):
    rows = route_rows(standins.trip_payloads(spark, sf), F.col("epoch"))
    plain = [c for c in RAW_TRAFFIC.schema.names if c != "steps"]
    return rows.select(
        *plain,
        F.size("steps").alias("n_steps"),
        first(F.col("steps"))["html_instructions"].alias("first_instruction"),
        F.try_element_at("steps", F.lit(-1))["distance"].alias("last_distance"),
        F.col("_position").alias("position"),
        F.col("_reason").alias("reason"),
    )


@query(
    "q07_open_absent_table",
    "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
)
def q07(spark, sf):
    customer = table(spark, sf, "customer")
    absent = open_table(spark, scratch_path(spark, "q07"), customer.schema)
    return union_aligned(absent, customer)


# --- Storage jobs -----------------------------------------------------------------

CORRECTED_SQL = f"""
{EVENTS_SQL},
sent as (
    select user_id, value, event_type, k, e, dt, 1 as arrival from events_k
    union all
    select user_id, value + 10, event_type, k, e, dt, 0 from events_k where event_type = 'error'
),
raw_weather as (
    select * from sent
    qualify row_number() over (
        partition by user_id, dt order by e desc, arrival, cast(value as float), event_type, k
    ) = 1
)"""


def loaded_weather(spark: SparkSession, sf: str, purpose: str) -> str:
    """Load all readings, then the corrected ones; returns the base directory."""
    base = scratch_path(spark, purpose)
    load_weather(standins.event_weather(spark, sf), base, "first")
    load_weather(standins.event_corrections(spark, sf), base, "corrections")
    return base


@query(
    "q08_partition_upsert",
    f"""with {CORRECTED_SQL}
    select cast(user_id as int) as id, 'City ' || user_id as city,
           cast(cast(value as float) as double) as temp, event_type as weather_description,
           k as humidity, e as load_dt, dt
    from raw_weather""",
)
def q08(spark, sf):
    base = loaded_weather(spark, sf, "q08")
    raw = open_table(spark, RAW_WEATHER.path(base), RAW_WEATHER.schema)
    return doubles(
        raw.select("id", "city", "temp", "weather_description", "humidity", "load_dt", "dt")
    )


@query(
    "q09_promotion",
    f"""with {CORRECTED_SQL}
    select cast(user_id as int) as nu_cidade, 'City ' || user_id as cidade, 'BR' as pais,
           cast(cast(value as float) as double) as temperatura,
           event_type as descricao_tempo, k as umidade, e as dt_carga, dt
    from raw_weather
    qualify row_number() over (partition by user_id order by e desc) = 1""",
)
def q09(spark, sf):
    base = scratch_path(spark, "q09")
    load_weather(standins.event_weather(spark, sf), base, "first")
    promote_weather(spark, base, "first")
    report = load_weather(standins.event_corrections(spark, sf), base, "corrections")
    promote_weather(spark, base, "corrections", dates=report.partitions)
    trusted = read_snapshot(spark, TRUSTED_WEATHER.path(base), TRUSTED_WEATHER.schema)
    return doubles(
        trusted.select(
            "nu_cidade", "cidade", "pais", "temperatura", "descricao_tempo", "umidade",
            "dt_carga", "dt",
        )
    )


@query(
    "q10_serving_rows",
    f"""with {TRIPS_SQL}
    select nu_rota, nu_cidade_origem, nu_cidade_destino, quantity || ' km' as cd_distancia,
           dt_carga, dt,
           '[' || array_to_string([('{{"instruction":"turn ' || i || '"}}') for i in range(1, line + 1)], ',')
               || ']' as passos
    from routes""",
)
def q10(spark, sf):
    """What the JDBC sink receives: nested columns as JSON text."""
    served = nested_to_json(standins.trip_routes(spark, sf))
    return served.select(
        "nu_rota", "nu_cidade_origem", "nu_cidade_destino", "cd_distancia", "dt_carga", "dt",
        "passos",
    )


# --- Projections, filters, merges -------------------------------------------------


@query(
    "q11_derived_columns",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber,
              l_extendedprice * (1 - l_discount) as net,
              case when l_returnflag = 'R' then 'returned' else 'kept' end as outcome
       from lineitem""",
)
def q11(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns(
        {
            "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
            "outcome": F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept"),
        }
    )
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "net", "outcome")


@query(
    "q12_positional_rename",
    """select c_custkey as nu_cliente, c_mktsegment as c_name, c_nationkey as nu_pais,
              c_acctbal as saldo, c_name as c_mktsegment from customer""",
)
def q12(spark, sf):
    customer = table(spark, sf, "customer")
    source = T.StructType(
        [customer.schema[c] for c in ("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", "c_name")]
    )
    target = struct(
        ("nu_cliente", T.LongType()), ("c_name", T.StringType()), ("nu_pais", T.IntegerType()),
        ("saldo", T.DoubleType()), ("c_mktsegment", T.StringType()),
    )
    return rename_by_position(customer, source, target)


@query(
    "q13_latest_per_key",
    """select user_id, event_id, event_type, value, props from events where user_id is not null
       qualify row_number() over (partition by user_id order by ts desc, event_id) = 1""",
)
def q13(spark, sf):
    newest = latest_per_key(table(spark, sf, "events"), ["user_id"], "ts", [F.asc("event_id")])
    return newest.select("user_id", "event_id", "event_type", "value", "props")


@query(
    "q14_element_access",
    """select vec_id, cast(embedding[1] as double) as head, cast(null as double) as beyond,
              label from embeddings""",
)
def q14(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return vectors.select(
        "vec_id",
        first(F.col("embedding")).cast("double").alias("head"),
        F.get("embedding", F.size("embedding")).cast("double").alias("beyond"),
        "label",
    )


ENRICHED_SQL = f"""
    select nu_rota, nu_cidade_origem as nu_origem, cidade_origem as origem,
           cidade_origem || ', BR' as ponto_partida, w.description as descricao_tempo_origem,
           cast(cast(w.temp as float) as double) as temp_origem,
           cast(cast(w.temp + 0.5 as float) as double) as sensacao_termica_origem,
           cast(cast(w.temp - 1 as float) as double) as temp_minima_origem,
           cast(cast(w.temp + 1 as float) as double) as temp_max_origem,
           case when w.status = 'F' then w.id end as altitude_origem,
           nu_cidade_destino as nu_destino, cidade_destino as destino,
           cidade_destino || ', BR' as ponto_chegada, v.description as descricao_tempo_destino,
           cast(cast(v.temp as float) as double) as temp_destino,
           cast(cast(v.temp + 0.5 as float) as double) as sensacao_termica_destino,
           cast(cast(v.temp - 1 as float) as double) as temp_minima_destino,
           cast(cast(v.temp + 1 as float) as double) as temp_max_destino,
           case when v.status = 'F' then v.id end as altitude_destino,
           quantity || ' km' as cd_distancia, cast(quantity * 1000 as int) as distancia,
           lines || ' min' as cd_duracao, cast(lines * 60 as int) as duracao,
           cast(line as int) as n_passos, cast({LOAD_TS} as bigint) as dt_carga, routes.dt as dt
    from routes
    join weather w on nu_cidade_origem = w.id and routes.dt = w.dt
    join weather v on nu_cidade_destino = v.id and routes.dt = v.dt"""


def latest_readings(spark: SparkSession, sf: str) -> DataFrame:
    """One reading per nation and date, under trusted names."""
    ties = [
        F.asc("weather_description"), F.asc("temp"), F.asc("wind_speed"), F.asc_nulls_last("sea_level"),
    ]
    raw = latest_per_key(standins.order_readings(spark, sf), ["id", "dt"], "load_dt", ties)
    return standins.as_trusted_weather(raw)


@query("q15_route_enrichment", f"with {TRIPS_SQL}, {READINGS_SQL} {ENRICHED_SQL}")
def q15(spark, sf):
    described = enrich_routes(
        standins.trip_routes(spark, sf), latest_readings(spark, sf), LOAD_TS
    )
    return doubles(described.withColumn("n_passos", F.size("passos")).drop("passos"))


@query(
    "q16_quarantine_split",
    """select case event_type when 'error' then 'corrupt' when 'purchase' then 'corrupt'
                   when 'signup' then 'null_id' when 'click' then 'out_of_range'
                   else 'accepted' end as outcome,
              count(*) as n, cast(sum(length(text)) as bigint) as kept_text
       from (select event_type, case event_type when 'error' then '{"id": ' || user_id
                    when 'purchase' then '{"id": ' || user_id || ', "main": {"temp": "mild"}}'
                    when 'signup' then '{"dt": 1700000000}'
                    when 'click' then '{"id": 9999999999, "dt": 1700000000}' end as text
             from events)
       group by 1""",
)
def q16(spark, sf):
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    events = standins.keyed_events(spark, sf)
    broken = (
        F.when(kind == "error", F.concat(F.lit('{"id": '), user))
        .when(kind == "purchase", F.concat(F.lit('{"id": '), user, F.lit(', "main": {"temp": "mild"}}')))
        .when(kind == "signup", F.lit('{"dt": 1700000000}'))
        .when(kind == "click", F.lit('{"id": 9999999999, "dt": 1700000000}'))
        .otherwise(standins.weather_payload(F.col("value")))
    )
    rows = weather_rows(events.select(broken.alias("payload")))
    return rows.groupBy(F.coalesce("_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("n"), F.sum(F.length("_payload")).alias("kept_text")
    )


@query(
    "q17_membership_filter",
    """select o_orderkey, o_custkey, o_orderpriority from orders
       where o_orderpriority in ('1-URGENT', '2-HIGH')
         and o_orderstatus = 'F' and o_custkey % 7 in (1, 2) and o_custkey <= 400
         and o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def q17(spark, sf):
    """A short list, a long list and a table of values through the same filter."""
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    urgent = among(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    listed = among(urgent, "o_custkey", [k for k in range(401) if k % 7 in (1, 2)])
    builders = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    chosen = among(listed, "o_custkey", sized(builders, "builders", keep=True))
    return chosen.select("o_orderkey", "o_custkey", "o_orderpriority")


@query(
    "q18_city_pair_resolution",
    f"""with {TRIPS_SQL}, {READINGS_SQL}
    select upper(cidade_origem) as origin, lower(cidade_destino) as destination, routes.dt as dt,
           dt_carga as request, w.id as nu_cidade_origin, w.city as cidade_origin,
           v.id as nu_cidade_destination, v.city as cidade_destination,
           case when w.id is null or v.id is null then null else w.id || '_' || v.id end as route_uuid,
           case when w.id is null or v.id is null then 'missing' else 'resolved' end as status
    from (select * replace (replace(cidade_origem, 'A', 'Ã') as cidade_origem) from routes) routes
    left join weather w on lower(strip_accents(cidade_origem)) = lower(w.city) and routes.dt = w.dt
    left join weather v on lower(cidade_destino) = lower(v.city) and routes.dt = v.dt""",
)
def q18(spark, sf):
    routes = standins.trip_routes(spark, sf)
    requests = routes.select(
        F.upper(F.replace("cidade_origem", F.lit("A"), F.lit("Ã"))).alias("origin"),
        F.lower("cidade_destino").alias("destination"),
        "dt",
        F.col("dt_carga").alias("request"),
    )
    return resolve_city_pairs(requests, latest_readings(spark, sf))


@query(
    "q19_missing_references",
    f"""with {TRIPS_SQL}, {READINGS_SQL},
    used as (select nu_cidade_origem as nu_cidade, dt from routes
             union select nu_cidade_destino, dt from routes)
    select nu_cidade, dt from used
    where not exists (select 1 from weather where id = nu_cidade and weather.dt = used.dt)""",
)
def q19(spark, sf):
    routes = standins.trip_routes(spark, sf)
    return missing_references(routes, latest_readings(spark, sf), "nu_cidade", "dt", ROLES)


@query(
    "q20_load_metrics",
    """select count(*) as rows,
              count(*) filter (where event_type = 'error') as null_id,
              count(*) filter (where event_type = 'purchase') as null_dt,
              count(*) filter (where event_type not in ('error', 'purchase')) as written
       from events""",
)
def q20(spark, sf):
    """Figures observed while a partitioned table is written without its NULL partition."""
    kind = F.col("event_type")
    readings = standins.keyed_events(spark, sf).select(
        F.when(kind != "error", F.col("user_id")).alias("id"),
        "value",
        F.when(kind != "purchase", epoch_to_dt(F.col("epoch"))).alias("dt"),
    )
    counted, figures = observed(readings, row_metrics(["id", "dt"]))
    path = scratch_path(spark, "q20")
    overwrite_partitions(with_required(counted, ["id", "dt"]), path, "dt")
    written = open_table(spark, path, readings.schema).agg(F.count("*").alias("written"))
    return written.select(
        *[F.lit(figures.get[name]).cast("long").alias(name) for name in ("rows", "null_id", "null_dt")],
        "written",
    )


@query(
    "q21_union_by_name",
    """select c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance from customer
       union all by name
       select s_acctbal as balance, s_name as name, s_suppkey as id, s_nationkey as nation from supplier""",
)
def q21(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"),
    )
    return union_aligned(customers, suppliers)


# --- Scalar functions -------------------------------------------------------------


@query(
    "q22_fold_text",
    """select doc_id, replace(strip_accents(lower(text)), 'ß', 'ss') as folded from documents""",
)
def q22(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold(F.col("text")).alias("folded"))


@query(
    "q23_epoch_to_date",
    """select event_id, strftime(ts, '%Y-%m-%d') as dt_utc,
              strftime(ts - interval 3 hour, '%Y-%m-%d') as dt_sao_paulo from events""",
)
def q23(spark, sf):
    seconds = epoch(F.col("ts"))
    return table(spark, sf, "events").select(
        "event_id",
        epoch_to_dt(seconds).alias("dt_utc"),
        epoch_to_dt(seconds, "America/Sao_Paulo").alias("dt_sao_paulo"),
    )


@query(
    "q24_composite_key",
    """select l_orderkey || '_' || l_linenumber as line_key,
              case when l_returnflag <> 'N' then l_orderkey || '_' || l_returnflag end as return_key
       from lineitem""",
)
def q24(spark, sf):
    returned = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select(
        composite_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("line_key"),
        composite_key(F.col("l_orderkey"), returned).alias("return_key"),
    )


@query(
    "q25_nested_to_json",
    """select conv_id, turn,
              cast(to_json([map {'role': role, 'text': text}]) as varchar) as steps,
              cast(to_json({'turn': turn, 'role': role}) as varchar) as head
       from conversations""",
)
def q25(spark, sf):
    turns = table(spark, sf, "conversations")
    step = F.create_map(F.lit("role"), F.col("role"), F.lit("text"), F.col("text"))
    return nested_to_json(
        turns.select(
            "conv_id", "turn", F.array(step).alias("steps"), F.struct("turn", "role").alias("head")
        )
    )


@query(
    "q26_json_number_truncation",
    """select c_custkey, cast(trunc(c_acctbal) as int) as whole_balance,
              cast(cast(c_acctbal as float) as double) as balance,
              cast(case when c_acctbal < 0 then null else trunc(c_acctbal * 1000) end as bigint) as scaled,
              9007199254740993 + c_custkey as beyond_double,
              case when c_custkey % 2 = 0 then cast(-2147483648 as int) end as lowest
       from customer""",
)
def q26(spark, sf):
    """Whole numbers are cut off from JSON text without a detour over doubles."""
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    lowest = F.lit(-(2**31)) - key % 2  # one less does not fit
    payload = F.to_json(
        F.struct(
            balance.alias("b"), F.when(balance >= 0, balance * 1000).alias("s"),
            (key + 9_007_199_254_740_993).alias("n"), lowest.alias("i"),
        )
    )
    parsed = table(spark, sf, "customer").select(
        "c_custkey",
        F.from_json(payload, "b double, s decimal(38,18), n decimal(38,18), i decimal(38,18)").alias("r"),
        F.from_json(payload, "b decimal(38,18)").alias("t"),
    )
    return doubles(
        parsed.select(
            "c_custkey",
            whole(F.col("t.b"), T.IntegerType()).alias("whole_balance"),
            whole(F.col("r.b"), T.FloatType()).alias("balance"),
            whole(F.col("r.s"), T.LongType()).alias("scaled"),
            whole(F.col("r.n"), T.LongType()).alias("beyond_double"),
            whole(F.col("r.i"), T.IntegerType()).alias("lowest"),
        )
    )


# --- Star schema ------------------------------------------------------------------


@query(
    "q27_city_dimension",
    f"""with {READINGS_SQL}
    select id as nu_cidade, city as cidade, 'BR' as pais, cast(id as double) as longitude,
           cast(-id as double) as latitude, load_dt as dt_carga, dt
    from readings qualify row_number() over (partition by id order by load_dt desc) = 1""",
)
def q27(spark, sf):
    newest = latest_per_key(standins.order_readings(spark, sf), ["id"], "load_dt")
    return doubles(star.city_dimension(standins.as_trusted_weather(newest)))


@query(
    "q28_weather_dimension",
    f"""with {READINGS_SQL}
    select id || '_' || load_dt as nu_clima, id as nu_cidade, description as descricao_tempo,
           cast(cast(temp as float) as double) as temperatura,
           cast(cast(temp + 0.5 as float) as double) as sensacao_termica,
           cast(cast(temp - 1 as float) as double) as temperatura_minima,
           cast(cast(temp + 1 as float) as double) as temperatura_maxima,
           1000 as pressao, cast(length(description) as int) as umidade,
           cast(null as int) as visibilidade,
           cast(cast(acctbal as float) as double) as velocidade_vento, 180 as direcao_vento,
           cast(null as double) as rajada_vento,
           case when status = 'F' then id end as nivel_do_mar, cast(null as int) as nivel_do_solo,
           load_dt - 3600 as nascer_do_sol, load_dt + 3600 as por_do_sol,
           load_dt as dt_carga, dt
    from weather""",
)
def q28(spark, sf):
    return doubles(star.weather_dimension(latest_readings(spark, sf)))


@query(
    "q29_route_dimension",
    f"""with {TRIPS_SQL}
    select nu_rota, nu_cidade_origem, cidade_origem, nu_cidade_destino, cidade_destino,
           quantity || ' km' as cd_distancia, cast(quantity * 1000 as int) as distancia,
           cast(to_timestamp(dt_carga) as date) as dt_carga, cast(dt as date) as dt
    from routes
    qualify row_number() over (partition by nu_rota order by routes.dt_carga desc) = 1""",
)
def q29(spark, sf):
    newest = latest_per_key(standins.trip_routes(spark, sf), ["nu_rota"], "dt_carga")
    return star.route_dimension(newest)


DAILY_ROUTES_SQL = """
daily as (
    select * from routes
    qualify row_number() over (partition by nu_rota, dt order by dt_carga desc) = 1
)"""


def daily_routes(spark: SparkSession, sf: str) -> DataFrame:
    """One trip per route and date."""
    return latest_per_key(standins.trip_routes(spark, sf), ["nu_rota", "dt"], "dt_carga")


@query(
    "q30_route_fact",
    f"""with {TRIPS_SQL}, {DAILY_ROUTES_SQL}, {READINGS_SQL}
    select nu_rota, nu_cidade_origem, nu_cidade_destino,
           w.id || '_' || w.load_dt as nu_clima_origem,
           v.id || '_' || v.load_dt as nu_clima_destino,
           nu_rota || '_' || daily.dt as nu_passo, cast(lines * 60 as int) as duracao,
           cast(daily.dt as date) as dt
    from daily
    left join weather w on nu_cidade_origem = w.id and daily.dt = w.dt
    left join weather v on nu_cidade_destino = v.id and daily.dt = v.dt""",
)
def q30(spark, sf):
    climate = star.weather_dimension(latest_readings(spark, sf))
    return star.route_fact(daily_routes(spark, sf), climate)


@query(
    "q31_step_fact",
    f"""with {TRIPS_SQL}, {DAILY_ROUTES_SQL}, laid as (select *, unnest(range(line)) as i from daily)
    select nu_rota || '_' || dt as nu_passo, nu_cidade_origem, nu_cidade_destino,
           cast(i as int) as pos, 'turn ' || (i + 1) as instruction,
           cast(to_timestamp(dt_carga) as date) as dt_carga, cast(dt as date) as dt
    from laid""",
)
def q31(spark, sf):
    fact = star.step_fact(daily_routes(spark, sf))
    head = ["nu_passo", "nu_cidade_origem", "nu_cidade_destino", "dt_carga", "dt"]
    return fact.select(*head, F.posexplode("passos").alias("pos", "passo")).select(
        *head, "pos", F.col("passo")["instruction"].alias("instruction")
    )


# --- Whole pipelines --------------------------------------------------------------

PIPELINE_SQL = f"""
{CORRECTED_SQL},
raw_routes as (
    select user_id as o, k as d, value, event_type, e, dt from events_k
    qualify row_number() over (
        partition by user_id, k, dt order by e desc, cast(floor(value) as int) * 10 || ' m', event_type
    ) = 1
),
trusted_routes as (
    select * from raw_routes
    qualify row_number() over (partition by o, d order by e desc) = 1
)"""


def trusted_zone(spark: SparkSession, sf: str, purpose: str) -> str:
    """Load and promote weather and routes of all events; returns the base directory."""
    base = loaded_weather(spark, sf, purpose)
    load_routes(standins.event_routes(spark, sf), base, "first", F.col("epoch"))
    promote_routes(spark, base, "first")
    return base


@query(
    "q32_route_description_job",
    f"""with {PIPELINE_SQL}
    select o || '_' || d as nu_rota, cast(o as int) as nu_origem, d as nu_destino,
           'City ' || o as origem, 'City ' || d as destino,
           w.event_type as descricao_tempo_origem,
           cast(cast(w.value as float) as double) as temp_origem,
           v.event_type as descricao_tempo_destino,
           cast(cast(v.value as float) as double) as temp_destino,
           case when v.event_type = 'click' then v.k end as altitude_destino,
           cast(floor(r.value) as int) * 10 as distancia, d * 60 as duracao,
           cast(1 + length(r.event_type) as int) as n_passos,
           cast({LOAD_TS} as bigint) as dt_carga, r.dt as dt
    from trusted_routes r
    join raw_weather w on r.o = w.user_id and r.dt = w.dt
    join raw_weather v on r.d = v.user_id and r.dt = v.dt""",
)
def q32(spark, sf):
    base = trusted_zone(spark, sf, "q32")
    describe_routes(spark, base, "first", LOAD_TS, on_missing="quarantine")
    described = read_snapshot(spark, ROUTE_DESCRIPTION.path(base), ROUTE_DESCRIPTION.schema)
    return doubles(
        described.select(
            "nu_rota", "nu_origem", "nu_destino", "origem", "destino", "descricao_tempo_origem",
            "temp_origem", "descricao_tempo_destino", "temp_destino", "altitude_destino",
            "distancia", "duracao", F.size("passos").alias("n_passos"), "dt_carga", "dt",
        )
    )


@query(
    "q33_routes_without_weather",
    f"""with {PIPELINE_SQL}
    select o || '_' || d as nu_rota, r.dt as dt,
           'no_weather:' || case when w.user_id is null and v.user_id is null then 'origem,destino'
                                 when w.user_id is null then 'origem' else 'destino' end as reason
    from trusted_routes r
    left join raw_weather w on r.o = w.user_id and r.dt = w.dt
    left join raw_weather v on r.d = v.user_id and r.dt = v.dt
    where w.user_id is null or v.user_id is null""",
)
def q33(spark, sf):
    base = trusted_zone(spark, sf, "q33")
    describe_routes(spark, base, "first", LOAD_TS, on_missing="quarantine")
    rejects = open_table(
        spark, ROUTE_DESCRIPTION.quarantine_path(base),
        struct(("reason", T.StringType()), ("payload", T.StringType()), ("batch_id", T.StringType())),
    )
    return rejects.select(
        F.get_json_object("payload", "$.nu_rota").alias("nu_rota"),
        F.get_json_object("payload", "$.dt").alias("dt"),
        "reason",
    )


@query(
    "q34_star_job",
    f"""with {PIPELINE_SQL}
    select o || '_' || d as nu_rota, cast(o as int) as nu_cidade_origem, d as nu_cidade_destino,
           w.user_id || '_' || w.e as nu_clima_origem, v.user_id || '_' || v.e as nu_clima_destino,
           o || '_' || d || '_' || r.dt as nu_passo, d * 60 as duracao, cast(r.dt as date) as dt,
           cast(1 + length(r.event_type) as int) as n_passos
    from raw_routes r
    left join raw_weather w on r.o = w.user_id and r.dt = w.dt
    left join raw_weather v on r.d = v.user_id and r.dt = v.dt""",
)
def q34(spark, sf):
    base = trusted_zone(spark, sf, "q34")
    promote_weather(spark, base, "first")
    star.build_star(spark, base)
    fact = open_table(spark, ROUTE_FACT.path(base), ROUTE_FACT.schema)
    step_lists = open_table(spark, STEP_FACT.path(base), STEP_FACT.schema)
    sizes = step_lists.select("nu_passo", F.size("passos").alias("n_passos"))
    return fact.join(sizes, "nu_passo").select(*ROUTE_FACT.schema.names, "n_passos")


@query(
    "q35_merge_with_ties",
    f"""with {TRIPS_SQL}
    select nu_rota, dt, quantity, line, arrival from (
        select nu_rota, dt, quantity, line, 1 as arrival from routes
        union all select nu_rota, dt, quantity + 1, line, 0 from routes where lines > 1)
    qualify row_number() over (partition by nu_rota order by dt desc, arrival, line, quantity) = 1""",
)
def q35(spark, sf):
    """Equal versions: incoming rows win over stored ones, then the lowest line number."""
    trip = standins.trips(spark, sf).select(
        composite_key(F.col("s_nationkey"), F.col("c_nationkey")).alias("nu_rota"),
        epoch_to_dt(F.col("epoch")).alias("dt"),
        "quantity", F.col("l_linenumber").alias("line"), "lines",
    )
    stored = trip.drop("lines").withColumn("arrival", F.lit(1))
    resent = trip.where(F.col("lines") > 1).select(
        "nu_rota", "dt", (F.col("quantity") + 1).alias("quantity"), "line",
        F.lit(0).alias("arrival"),
    )
    return merge_latest(stored, resent, ["nu_rota"], "dt", [F.asc("line"), F.asc("quantity")])


# --- Records, increments, reports -------------------------------------------------


@query(
    "q36_payload_account",
    """select case event_type when 'click' then 'corrupt' when 'view' then 'no_routes'
                   when 'error' then 'no_routes' else 'accepted' end as outcome,
              count(*) as payloads,
              2 * count(*) filter (where event_type not in ('click', 'view', 'error')) as accepted,
              count(*) filter (where event_type in ('click', 'view', 'error')) as rejected,
              count(distinct case when event_type = 'error' then 'one' else event_id::varchar end) as texts
       from events group by 1""",
)
def q36(spark, sf):
    """What became of each landed payload: none is lost, whatever it holds."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    good = standins.event_routes(spark, sf, "event_id", "event_type")
    payload = (
        F.when(kind == "click", F.concat(F.lit('{"routes": ['), number))
        .when(kind == "view", F.concat(F.lit('{"routes": [], "n": '), number, F.lit("}")))
        .when(kind == "error", F.lit('{"status": "REQUEST_DENIED"}'))
        .otherwise(F.concat(F.expr("left(payload, length(payload) - 1)"), F.lit(',"n":'), number, F.lit("}")))
    )
    base = scratch_path(spark, "q36")
    landed = good.withColumn("payload", payload)
    load_routes(landed, base, "first", F.col("epoch"), on_error="quarantine")
    account = spark.read.parquet(account_path(RAW_TRAFFIC, base))
    return account.groupBy("outcome").agg(
        *[F.sum(c).alias(c) for c in ("payloads", "accepted", "rejected")], F.count(F.lit(1)).alias("texts")
    )


LATE_DAY = 25  # weather from this day of the month on arrives after the first run

INCREMENT_SQL = f"""
{EVENTS_SQL},
rw as (
    select * from events_k
    qualify row_number() over (
        partition by user_id, dt order by e desc, cast(value as float), event_type, k
    ) = 1
),
r1 as (
    select * from events_k where event_type <> 'signup'
    qualify row_number() over (
        partition by user_id, k order by e desc, cast(floor(value) as int) * 10 || ' m', event_type
    ) = 1
),
r2 as (
    select * from events_k
    qualify row_number() over (
        partition by user_id, k
        order by e desc, event_type <> 'signup', cast(floor(value) as int) * 10 || ' m', event_type
    ) = 1
),
d1 as (
    select r.*, w.value as a, v.value as b, {LOAD_TS} as loaded from r1 r
    join rw w on r.user_id = w.user_id and r.dt = w.dt join rw v on r.k = v.user_id and r.dt = v.dt
    where day(r.dt::date) < {LATE_DAY}
),
d2 as (
    select r.*, w.value as a, v.value as b,
           case when day(r.dt::date) >= {LATE_DAY} or o.e is null or o.e <> r.e or o.event_id <> r.event_id
                then {LOAD_TS + 1} else {LOAD_TS} end as loaded
    from r2 r left join r1 o on o.user_id = r.user_id and o.k = r.k
    join rw w on r.user_id = w.user_id and r.dt = w.dt join rw v on r.k = v.user_id and r.dt = v.dt
),
described as (
    select * from d2
    union all select * from d1 where not exists (select 1 from d2 where d2.user_id = d1.user_id and d2.k = d1.k)
)"""


@query(
    "q37_incremental_description",
    f"""with {INCREMENT_SQL}
    select user_id || '_' || k as nu_rota, cast(cast(a as float) as double) as temp_origem,
           cast(cast(b as float) as double) as temp_destino,
           cast(floor(value) as int) * 10 as distancia, cast(loaded as bigint) as dt_carga, dt
    from described""",
)
def q37(spark, sf):
    """Weather of late days and some routes arrive after a first run; the second run joins
    only the routes that these touch, and gives the table of a full run."""
    base = scratch_path(spark, "q37")
    day = F.dayofmonth("ts")
    weather = standins.event_weather(spark, sf, "ts")
    routes = standins.event_routes(spark, sf, "event_type")
    load_weather(weather.where(day < LATE_DAY), base, "first")
    load_routes(routes.where("event_type <> 'signup'"), base, "first", F.col("epoch"))
    promote_routes(spark, base, "first")
    first_run = describe_routes(spark, base, "first", LOAD_TS, on_missing="quarantine")
    late = load_weather(weather.where(day >= LATE_DAY), base, "late")
    more = load_routes(routes.where("event_type = 'signup'"), base, "late", F.col("epoch"))
    promote_routes(spark, base, "late", dates=more.dates)
    describe_routes(
        spark, base, "late", LOAD_TS + 1, on_missing="quarantine",
        since=first_run.routes, weather_dates=late.dates,
    )
    described = read_snapshot(spark, ROUTE_DESCRIPTION.path(base), ROUTE_DESCRIPTION.schema)
    return doubles(
        described.select("nu_rota", "temp_origem", "temp_destino", "distancia", "dt_carga", "dt")
    )


@query(
    "q38_fact_orphans",
    f"""with {TRIPS_SQL}, {DAILY_ROUTES_SQL}, {READINGS_SQL},
    known as (select * from weather where description <> '1-URGENT'),
    fact as (
        select daily.dt, o.id || '_' || o.load_dt as wo, d.id || '_' || d.load_dt as wd,
               nu_cidade_origem as co, nu_cidade_destino as cd
        from daily
        left join weather o on nu_cidade_origem = o.id and daily.dt = o.dt
        left join weather d on nu_cidade_destino = d.id and daily.dt = d.dt
    ),
    used as (
        select dt, 'nu_clima_origem' as "column", 'dm_clima' as dimension, wo as key from fact
        union all select dt, 'nu_clima_destino', 'dm_clima', wd from fact
        union all select dt, 'nu_cidade_origem', 'dm_cidade', co::varchar from fact
        union all select dt, 'nu_cidade_destino', 'dm_cidade', cd::varchar from fact
    )
    select cast(dt as date) as dt, "column", dimension, key, count(*) as rows from used
    where (dimension = 'dm_clima' and (key is null or key not in (select id || '_' || load_dt from known)))
       or (dimension = 'dm_cidade'
           and key not in (select n_nationkey::varchar from nation where n_nationkey % 5 > 0))
    group by 1, 2, 3, 4""",
)
def q38(spark, sf):
    """Keys of the route fact that no dimension row has, here with rows taken out of two."""
    climate = star.weather_dimension(latest_readings(spark, sf))
    routes = daily_routes(spark, sf)
    nations = table(spark, sf, "nation").where("n_nationkey % 5 > 0")
    return star.orphans(
        star.route_fact(routes, climate),
        {
            "dm_clima": climate.where("descricao_tempo <> '1-URGENT'"),
            "dm_cidade": nations.select(F.col("n_nationkey").alias("nu_cidade")),
            "dm_rota": routes,
            "fp_passo": star.step_fact(routes),
        },
    )


@query(
    "q39_route_requests",
    f"""with {TRIPS_SQL}, {EVENTS_SQL},
    city as (
        select distinct user_id, case user_id % 10 when 9 then 'Gêmea' else 'City ' || user_id end as city, dt
        from events_k
    ),
    named as (select dt, lower(strip_accents(city)) as name, min(user_id) as low, max(user_id) as high from city group by all),
    asked as (
        select distinct upper(case user_id % 10 when 9 then 'Gêmea' else 'City ' || user_id end) as origin,
               'city ' || k as destination, dt from events_k
    )
    select origin, destination, asked.dt as dt,
           case when o.name is null or d.name is null then 'missing'
                when o.low <> o.high or d.low <> d.high then 'ambiguous' else 'resolved' end as status,
           case when o.low = o.high and d.low = d.high then o.low || '_' || d.low end as route_uuid
    from asked
    left join named o on o.name = lower(strip_accents(origin)) and o.dt = asked.dt
    left join named d on d.name = destination and d.dt = asked.dt""",
)
def q39(spark, sf):
    """City pairs by name to requests, with homonyms and cities that have no weather."""
    name = F.when(F.col("user_id") % 10 == 9, F.lit("Gêmea")).otherwise(
        F.concat(F.lit("City "), F.col("user_id").cast("string"))
    )
    base = scratch_path(spark, "q39")
    load_weather(standins.event_weather(spark, sf, name=name), base, "first")
    events = standins.keyed_events(spark, sf)
    asked = events.select(
        F.upper(name).alias("origin"), F.concat(F.lit("city "), F.col("k").cast("string")).alias("destination"),
        epoch_to_dt(F.col("epoch")).alias("dt"),
    )
    request_routes(asked, base, "first", on_error="quarantine")
    made = spark.read.parquet(ROUTE_REQUEST.path(base)).select(
        F.upper("origin_city").alias("origin"), F.lower("destination_city").alias("destination"), "dt",
        F.lit("resolved").alias("status"), "route_uuid",
    )
    lost = spark.read.parquet(ROUTE_REQUEST.quarantine_path(base)).select(
        F.from_json("payload", "origin string, destination string, dt string").alias("p"), "reason"
    )
    return made.unionByName(lost.select("p.*", F.col("reason").alias("status"), F.lit(None).cast("string").alias("route_uuid")))
