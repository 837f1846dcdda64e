from __future__ import annotations

import json

import pytest
from payloads import NOON, directions, landed, leg, weather
from pyspark.sql import functions as F

from tierflow.sources.payloads import payload_account, route_rows, weather_rows
from tierflow.specs import RAW_TRAFFIC, RAW_WEATHER


def test_weather_payload_becomes_a_typed_row(spark):
    df = weather_rows(landed(spark, weather(main={
        "temp": 21.5, "feels_like": 22, "temp_min": 20, "temp_max": 23.25,
        "pressure": 1013.7, "humidity": 80, "sea_level": 1010.9,
    })))
    assert df.select(*RAW_WEATHER.schema.names).dtypes == [(f.name, f.dataType.simpleString()) for f in RAW_WEATHER.schema]
    row = df.first()
    assert row["_reason"] is None and row["_payload"] is None
    assert row["id"] == 1 and row["city"] == "Resende" and row["country"] == "BR"
    assert row["weather_description"] == "nublado"
    assert row["temp"] == 21.5 and row["feels_like"] == 22.0
    assert row["pressure"] == 1013 and row["sea_level"] == 1010  # truncated, not rounded
    assert row["grnd_level"] is None and row["wind_gust"] is None
    assert row["visibility"] == 9000 and row["load_dt"] == NOON and row["dt"] == "2024-06-01"


def test_absent_numbers_default_to_zero_or_stay_null(spark):
    bare = {"id": 1, "dt": NOON}
    zero = weather_rows(landed(spark, bare)).first()
    null = weather_rows(landed(spark, bare), defaults=False).first()
    numbers = ["lon", "lat", "temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity",
               "visibility", "wind_speed", "wind_deg", "sunrise", "sunset"]
    assert [zero[c] for c in numbers] == [0] * len(numbers)
    assert [null[c] for c in numbers] == [None] * len(numbers)
    for row in (zero, null):
        assert row["_reason"] is None
        assert [row[c] for c in ("city", "country", "weather_description", "sea_level", "grnd_level", "wind_gust")] == [None] * 6


def test_empty_weather_list_leaves_the_description_null(spark):
    row = weather_rows(landed(spark, weather(weather=[]))).first()
    assert row["_reason"] is None and row["weather_description"] is None


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        ("{not json", "corrupt"),
        ("", "corrupt"),
        (None, "corrupt"),
        ("[1, 2]", "corrupt"),
        ({"id": 1, "dt": NOON, "main": {"temp": "mild"}}, "corrupt"),
        ({"id": 1, "dt": NOON, "main": 5}, "corrupt"),
        ({"cod": "404", "message": "city not found"}, "null_id"),
        ({"id": 1}, "null_dt"),
        ({"id": 3e9, "dt": NOON}, "out_of_range"),
        ({"id": 1, "dt": 1e17}, "null_dt"),
        ({"id": 1, "dt": 1e30}, "out_of_range"),
        ({"id": 1, "dt": NOON, "main": {"humidity": 1e12}}, "out_of_range"),
    ],
)
def test_unusable_weather_keeps_its_text(spark, payload, reason):
    row = weather_rows(landed(spark, payload)).first()
    assert row["_reason"] == reason
    assert row["_payload"] == (payload if payload is None or isinstance(payload, str) else json.dumps(payload))


def test_dt_follows_the_time_zone(spark):
    early = weather(dt=NOON - 12 * 3600)  # midnight UTC
    assert weather_rows(landed(spark, early)).first()["dt"] == "2024-06-01"
    assert weather_rows(landed(spark, early), time_zone="America/Sao_Paulo").first()["dt"] == "2024-05-31"


def test_directions_payload_gives_one_row_per_alternative(spark):
    body = directions(routes=[{"legs": [leg(1000), leg(5)]}, {"legs": [leg(2000)]}])
    df = route_rows(landed(spark, body), NOON)
    assert df.select(*RAW_TRAFFIC.schema.names).dtypes == [(f.name, f.dataType.simpleString()) for f in RAW_TRAFFIC.schema]
    rows = sorted(df.collect(), key=lambda r: r["_position"])
    assert [(r["_position"], r["travel_distance"]) for r in rows] == [(0, 1000), (1, 2000)]
    row = rows[0]
    assert row["route_uuid"] == "1_2" and row["origin_city"] == "Resende"
    assert row["destination_uuid"] == 2 and row["destination_city"] == "Lavras"
    assert row["cd_travel_distance"] == "1 km" and row["travel_duration"] == 600
    assert row["load_dt"] == NOON and row["dt"] == "2024-06-01" and row["_reason"] is None
    assert row["steps"][0]["html_instructions"] == "vire à direita"
    assert json.loads(row["steps"][0]["distance"]) == {"text": "1 km", "value": 1000}
    assert row["steps"][1] == {"html_instructions": "siga", "travel_mode": "DRIVING"}


def test_load_time_may_be_a_column(spark):
    df = landed(spark, directions()).withColumn("fetched", F.lit(NOON + 86_400))
    row = route_rows(df, F.col("fetched")).first()
    assert row["load_dt"] == NOON + 86_400 and row["dt"] == "2024-06-02"


def test_a_payload_without_routes_is_on_record(spark):
    nothing = {k: v for k, v in directions().items() if k != "routes"}
    batch = [directions(routes=[]), nothing, {"status": "REQUEST_DENIED"}]
    rows = route_rows(landed(spark, *batch), NOON).collect()
    assert [r["_reason"] for r in rows] == ["no_routes"] * 3
    assert {r["_payload"] for r in rows} == {json.dumps(b, ensure_ascii=False) for b in batch}


def test_every_landed_payload_is_accounted_for_once(spark):
    big = {"legs": [leg(3_000_000_000)]}
    batch = [
        directions(), directions(), directions(routes=[{"legs": [leg()]}, {"legs": [leg(2)]}]),
        directions(routes=[]), "{bad", None, "", directions(origin=(None, "x")), directions(routes=[big]),
    ]
    account = payload_account(route_rows(landed(spark, *batch), NOON)).collect()
    assert sum(r["payloads"] for r in account) == len(batch)
    outcomes = {}
    for r in account:
        outcomes[r["outcome"]] = outcomes.get(r["outcome"], 0) + r["payloads"]
    assert outcomes == {"accepted": 3, "no_routes": 1, "corrupt": 4, "null_route_uuid": 1}
    assert max(r["payloads"] for r in account) == 2 and max(r["accepted"] for r in account) == 2


@pytest.mark.parametrize(
    "column, text, want",
    [
        ("load_dt", "9007199254740993", None),  # beyond the years of a date: the row has no dt
        ("id", "-2147483648", -(2**31)), ("id", "-2147483648.9", -(2**31)), ("id", "2147483647.9", 2**31 - 1),
        ("id", "2147483648", "out_of_range"), ("id", "-2147483649", "out_of_range"), ("id", "1e1", 10), ("id", "1e300", "out_of_range"), ("id", "5.9999999999999999", 5),
        ("temp", "3.4028235e38", 3.4028234663852886e38), ("temp", "1e39", "out_of_range"), ("temp", "-1e300", "out_of_range"),
        ("sunrise", "9007199254740993", 9007199254740993), ("sunrise", "9223372036854775807", 2**63 - 1),
        ("sunrise", "9223372036854775808", "out_of_range"), ("sunset", "-9223372036854775808", -(2**63)),
    ],
)
def test_numbers_keep_their_digits_or_are_rejected(spark, column, text, want):
    body = {"id": "1", "load_dt": str(NOON), "temp": "1", "sunrise": "2", "sunset": "3", column: text}
    payload = (
        f'{{"id": {body["id"]}, "dt": {body["load_dt"]}, "main": {{"temp": {body["temp"]}}}, '
        f'"sys": {{"sunrise": {body["sunrise"]}, "sunset": {body["sunset"]}}}}}'
    )
    row = weather_rows(landed(spark, payload)).first()
    if isinstance(want, str):
        assert row["_reason"] == want and row["_payload"] == payload
    elif want is None:
        assert row["_reason"] == "null_dt" and row[column] == int(text)
    else:
        assert row["_reason"] is None and row[column] == want


def test_missing_leg_leaves_fields_null(spark):
    row = route_rows(landed(spark, directions(routes=[{"legs": []}])), NOON).first()
    assert row["_reason"] is None and row["steps"] is None and row["travel_distance"] is None


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        ("{not json", "corrupt"),
        (None, "corrupt"),
        (directions(routes=[{"legs": [leg(distance={"text": "x", "value": 1.5})]}]), "corrupt"),
        ({k: v for k, v in directions().items() if k != "route"}, "null_route_uuid"),
        (directions(origin=(None, "Resende")), "null_route_uuid"),
    ],
)
def test_unusable_directions_keep_their_text(spark, payload, reason):
    row = route_rows(landed(spark, payload), NOON).first()
    assert row["_reason"] == reason
    text = payload if payload is None or isinstance(payload, str) else json.dumps(payload, ensure_ascii=False)
    assert row["_payload"] == text


def test_payload_is_parsed_once_per_row(spark):
    """Weather texts that fail get a second look behind a CASE."""
    for df, times in ((weather_rows(landed(spark, weather())), 2), (route_rows(landed(spark, directions()), NOON), 1)):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json(") == times
