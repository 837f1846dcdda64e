"""JDBC publication, with the writer replaced by a recorder: no database is started."""

from __future__ import annotations

import json

import pytest
from payloads import NOON, directions, landed, weather

from tierflow.plans.promotion import promote_routes, promote_weather
from tierflow.plans.raw_load import load_routes, load_weather
from tierflow.plans.serving import publish_table, serving_source
from tierflow.sinks import jdbc
from tierflow.specs import RAW_TRAFFIC, TRUSTED_TRAFFIC, TRUSTED_WEATHER

OPTIONS = jdbc.jdbc_options(
    "jdbc:postgresql://db/x", "painel", "rotas", properties={"user": "u"}, connections=4
)


class Recorder:
    def __init__(self, calls):
        self.calls = calls

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        self.calls["saved"] = True


@pytest.fixture
def recorded(monkeypatch):
    calls = {}

    def writer(df):
        calls["df"] = df
        return Recorder(calls)

    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "write", property(writer))
    return calls


def test_options():
    assert OPTIONS == {
        "url": "jdbc:postgresql://db/x", "dbtable": "painel.rotas", "driver": "org.postgresql.Driver",
        "user": "u", "numPartitions": "4", "batchsize": "10000", "truncate": "true",
    }


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_publication_encodes_nested_columns(spark, base_dir, request, mode):
    load_routes(landed(spark, directions()), base_dir, "b1", NOON)
    promote_routes(spark, base_dir, "b1")
    calls = request.getfixturevalue("recorded")
    publish_table(spark, TRUSTED_TRAFFIC, base_dir, OPTIONS, mode)
    assert calls["format"] == "jdbc" and calls["mode"] == mode and calls["saved"]
    assert calls["options"] == OPTIONS
    row = calls["df"].first()
    assert dict(calls["df"].dtypes)["passos"] == "string"
    assert json.loads(row["passos"])[1] == {"html_instructions": "siga", "travel_mode": "DRIVING"}


def test_table_without_nested_columns(spark, base_dir, request):
    load_weather(landed(spark, weather(1)), base_dir, "b1")
    promote_weather(spark, base_dir, "b1")
    calls = request.getfixturevalue("recorded")
    publish_table(spark, TRUSTED_WEATHER, base_dir, OPTIONS)
    assert calls["mode"] == "overwrite" and calls["df"].count() == 1


def test_partitioned_table_is_served_whole(spark, base_dir):
    load_routes(landed(spark, directions()), base_dir, "b1", NOON)
    assert serving_source(spark, RAW_TRAFFIC, base_dir).count() == 1


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError, match="mode"):
        jdbc.publish_jdbc(spark.range(1), OPTIONS, "upsert")
