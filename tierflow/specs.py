"""Declared tables: schema, key, version column, partitioning and required fields.

A table is a directory of parquet files plus a declared ``StructType``, found at
``{base_dir}/{zone}/{name}``.  Schemas are always applied on read and on write, so
nothing is inferred from file contents or from partition directory names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT, LONG, FLOAT, STR, DATE = (
    T.IntegerType(),
    T.LongType(),
    T.FloatType(),
    T.StringType(),
    T.DateType(),
)
STEPS = T.ArrayType(T.MapType(STR, STR))


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives and which row of a key survives.

    ``key`` identifies a row, ``version`` orders the copies of one key (highest wins),
    ``required`` lists the columns that must be filled before a row leaves its zone.
    """

    zone: str
    name: str
    schema: T.StructType
    key: str
    version: str | None = None
    partition: str | None = None
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()

    def path(self, base_dir: str) -> str:
        return f"{base_dir.rstrip('/')}/{self.zone}/{self.name}"

    def quarantine_path(self, base_dir: str) -> str:
        return f"{base_dir.rstrip('/')}/quarantine/{self.zone}/{self.name}"


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# --- Fixed values -----------------------------------------------------------------
# Zone, table and column names and types are the published data model; a reader of
# these tables depends on them letter by letter.

RAW_WEATHER = TableSpec(
    zone="raw",
    name="weather_data",
    key="id",
    version="load_dt",
    partition="dt",
    schema=struct(
        ("id", INT),
        ("city", STR),
        ("country", STR),
        ("lon", FLOAT),
        ("lat", FLOAT),
        ("weather_description", STR),
        ("temp", FLOAT),
        ("feels_like", FLOAT),
        ("temp_min", FLOAT),
        ("temp_max", FLOAT),
        ("pressure", INT),
        ("humidity", INT),
        ("sea_level", INT),
        ("grnd_level", INT),
        ("visibility", INT),
        ("wind_speed", FLOAT),
        ("wind_deg", INT),
        ("wind_gust", FLOAT),
        ("sunrise", LONG),
        ("sunset", LONG),
        ("load_dt", LONG),
        ("dt", STR),
    ),
    required=(
        "id", "city", "country", "lon", "lat", "weather_description", "temp",
        "feels_like", "temp_min", "temp_max", "pressure", "humidity", "wind_speed",
        "wind_deg", "sunrise", "sunset", "load_dt", "dt",
    ),
    optional=("sea_level", "grnd_level", "visibility", "wind_gust"),
)

TRUSTED_WEATHER = TableSpec(
    zone="trusted",
    name="dados_climaticos",
    key="nu_cidade",
    version="dt_carga",
    schema=struct(
        ("nu_cidade", INT),
        ("cidade", STR),
        ("pais", STR),
        ("longitude", FLOAT),
        ("latitude", FLOAT),
        ("descricao_tempo", STR),
        ("temperatura", FLOAT),
        ("sensacao_termica", FLOAT),
        ("temperatura_minima", FLOAT),
        ("temperatura_maxima", FLOAT),
        ("pressao", INT),
        ("umidade", INT),
        ("nivel_do_mar", INT),
        ("nivel_do_solo", INT),
        ("visibilidade", INT),
        ("velocidade_vento", FLOAT),
        ("direcao_vento", INT),
        ("rajada_vento", FLOAT),
        ("nascer_do_sol", LONG),
        ("por_do_sol", LONG),
        ("dt_carga", LONG),
        ("dt", STR),
    ),
)

RAW_TRAFFIC = TableSpec(
    zone="raw",
    name="traffic_data",
    key="route_uuid",
    version="load_dt",
    partition="dt",
    schema=struct(
        ("route_uuid", STR),
        ("origin_uuid", INT),
        ("origin_city", STR),
        ("destination_uuid", INT),
        ("destination_city", STR),
        ("destination_start", STR),
        ("destination_end", STR),
        ("cd_travel_distance", STR),
        ("travel_distance", INT),
        ("cd_travel_duration", STR),
        ("travel_duration", INT),
        ("steps", STEPS),
        ("load_dt", LONG),
        ("dt", STR),
    ),
    required=(
        "route_uuid", "origin_uuid", "origin_city", "destination_uuid",
        "destination_city", "destination_start", "destination_end",
        "cd_travel_distance", "travel_distance", "cd_travel_duration",
        "travel_duration", "steps", "load_dt", "dt",
    ),
)

TRUSTED_TRAFFIC = TableSpec(
    zone="trusted",
    name="dados_trafego",
    key="nu_rota",
    version="dt_carga",
    schema=struct(
        ("nu_rota", STR),
        ("nu_cidade_origem", INT),
        ("cidade_origem", STR),
        ("nu_cidade_destino", INT),
        ("cidade_destino", STR),
        ("localizacao_inicial", STR),
        ("localizacao_final", STR),
        ("cd_distancia", STR),
        ("distancia", INT),
        ("cd_duracao", STR),
        ("duracao", INT),
        ("passos", STEPS),
        ("dt_carga", LONG),
        ("dt", STR),
    ),
)

ROUTE_DESCRIPTION = TableSpec(
    zone="trusted",
    name="descricao_rota",
    key="nu_rota",
    version="dt_carga",
    schema=struct(
        ("nu_rota", STR),
        ("nu_origem", INT),
        ("origem", STR),
        ("ponto_partida", STR),
        ("descricao_tempo_origem", STR),
        ("temp_origem", FLOAT),
        ("sensacao_termica_origem", FLOAT),
        ("temp_minima_origem", FLOAT),
        ("temp_max_origem", FLOAT),
        ("altitude_origem", INT),
        ("nu_destino", INT),
        ("destino", STR),
        ("ponto_chegada", STR),
        ("descricao_tempo_destino", STR),
        ("temp_destino", FLOAT),
        ("sensacao_termica_destino", FLOAT),
        ("temp_minima_destino", FLOAT),
        ("temp_max_destino", FLOAT),
        ("altitude_destino", INT),
        ("cd_distancia", STR),
        ("distancia", INT),
        ("cd_duracao", STR),
        ("duracao", INT),
        ("passos", STEPS),
        ("dt_carga", LONG),
        ("dt", STR),
    ),
)

CITY_DIM = TableSpec(
    zone="refined",
    name="dm_cidade",
    key="nu_cidade",
    version="dt_carga",
    schema=struct(
        ("nu_cidade", INT),
        ("cidade", STR),
        ("pais", STR),
        ("longitude", FLOAT),
        ("latitude", FLOAT),
        ("dt_carga", LONG),
        ("dt", STR),
    ),
)

WEATHER_DIM = TableSpec(
    zone="refined",
    name="dm_clima",
    key="nu_clima",
    version="dt_carga",
    partition="dt",
    schema=struct(
        ("nu_clima", STR),
        ("nu_cidade", INT),
        ("descricao_tempo", STR),
        ("temperatura", FLOAT),
        ("sensacao_termica", FLOAT),
        ("temperatura_minima", FLOAT),
        ("temperatura_maxima", FLOAT),
        ("pressao", INT),
        ("umidade", INT),
        ("visibilidade", INT),
        ("velocidade_vento", FLOAT),
        ("direcao_vento", INT),
        ("rajada_vento", FLOAT),
        ("nivel_do_mar", INT),
        ("nivel_do_solo", INT),
        ("nascer_do_sol", LONG),
        ("por_do_sol", LONG),
        ("dt_carga", LONG),
        ("dt", STR),
    ),
)

ROUTE_DIM = TableSpec(
    zone="refined",
    name="dm_rota",
    key="nu_rota",
    version="dt_carga",
    schema=struct(
        ("nu_rota", STR),
        ("nu_cidade_origem", INT),
        ("cidade_origem", STR),
        ("nu_cidade_destino", INT),
        ("cidade_destino", STR),
        ("cd_distancia", STR),
        ("distancia", INT),
        ("dt_carga", DATE),
        ("dt", DATE),
    ),
)

ROUTE_FACT = TableSpec(
    zone="refined",
    name="fp_rota",
    key="nu_rota",
    partition="dt",
    schema=struct(
        ("nu_rota", STR),
        ("nu_cidade_origem", INT),
        ("nu_cidade_destino", INT),
        ("nu_clima_origem", STR),
        ("nu_clima_destino", STR),
        ("nu_passo", STR),
        ("duracao", INT),
        ("dt", DATE),
    ),
)

STEP_FACT = TableSpec(
    zone="refined",
    name="fp_passo",
    key="nu_passo",
    partition="dt",
    schema=struct(
        ("nu_passo", STR),
        ("nu_cidade_origem", INT),
        ("nu_cidade_destino", INT),
        ("passos", STEPS),
        ("dt_carga", DATE),
        ("dt", DATE),
    ),
)

ROUTE_REQUEST = TableSpec(
    zone="raw",
    name="route_requests",
    key="route_uuid",
    schema=struct(
        ("route_uuid", STR),
        ("origin_uuid", INT),
        ("origin_city", STR),
        ("destination_uuid", INT),
        ("destination_city", STR),
        ("dt", STR),
    ),
)

# Payload fields the parsers read.  Numbers meant for whole columns are declared decimal, which
# keeps every digit, and truncated afterwards: ``from_json`` turns 10.7 into NULL when the field
# is declared int, and a double loses digits beyond 2^53.
NUMBER = "decimal(38,18)"
WEATHER_PAYLOAD = """
    id decimal(38,18), name string, dt decimal(38,18), visibility decimal(38,18),
    coord struct<lon: double, lat: double>,
    weather array<struct<description: string>>,
    main struct<temp: double, feels_like: double, temp_min: double, temp_max: double,
                pressure: decimal(38,18), humidity: decimal(38,18), sea_level: decimal(38,18),
                grnd_level: decimal(38,18)>,
    wind struct<speed: double, deg: decimal(38,18), gust: double>,
    sys struct<country: string, sunrise: decimal(38,18), sunset: decimal(38,18)>
"""

DIRECTIONS_PAYLOAD = """
    route struct<origin: struct<nu_cidade: int, cidade: string>,
                 destination: struct<nu_cidade: int, cidade: string>>,
    routes array<struct<legs: array<struct<
        start_address: string, end_address: string,
        distance: struct<text: string, value: int>,
        duration: struct<text: string, value: int>,
        steps: array<map<string, string>>>>>>
"""
# --- End of fixed values ----------------------------------------------------------
