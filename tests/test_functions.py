from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.columns import (
    composite_key, conform, first, nested_to_json, rename_by_position, whole,
)
from tierflow.functions.dates import epoch_to_date, epoch_to_dt
from tierflow.functions.text import fold
from tierflow.specs import RAW_TRAFFIC, RAW_WEATHER, TRUSTED_TRAFFIC, TRUSTED_WEATHER, struct


def test_fold_matches_names_without_accents(spark):
    names = [
        ("São José", "sao jose"), ("SÃO JOSÉ", "sao jose"), ("Sao Jose", "sao jose"),
        ("Straße", "strasse"), ("STRASSE", "strasse"), ("Æbeltoft", "aebeltoft"),
        ("Malmö", "malmo"), ("Tromsø", "tromso"), ("Łódź", "lodz"), ("Œuvre", "oeuvre"),
        ("São", "sao"), ("Santa Bárbara d’Oeste", "santa barbara d'oeste"),
        ("Þingvellir", "thingvellir"), ("İzmir", "izmir"), ("", ""), (None, None),
        ("ãõâôàúîïûåáéíóúñç", "aoaoauiiuaaeiounc"), ("東京", "東京"),
    ]
    df = spark.createDataFrame(names, "name string, want string")
    rows = df.select("name", "want", fold(F.col("name")).alias("got")).collect()
    assert [(r["name"], r["got"]) for r in rows] == [(r["name"], r["want"]) for r in rows]


def test_epoch_to_date_uses_the_named_zone_not_the_session(spark):
    seconds = [0, 1_717_210_799, 1_717_210_800, -1, None, 10**18, -(10**15)]
    df = spark.createDataFrame([(s,) for s in seconds], "s long")
    rows = df.select(
        epoch_to_dt(F.col("s")).alias("utc"),
        epoch_to_dt(F.col("s"), "America/Sao_Paulo").alias("sp"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("1970-01-01", "1969-12-31"), ("2024-06-01", "2024-05-31"), ("2024-06-01", "2024-06-01"),
        ("1969-12-31", "1969-12-31"), (None, None), (None, None), (None, None),
    ]
    assert df.select(epoch_to_date(F.col("s"))).first()[0] == date(1970, 1, 1)


def test_rename_swaps_names_and_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "x", True)], "a int, b string, extra boolean")
    out = rename_by_position(
        df, struct(("a", T.IntegerType()), ("b", T.StringType())),
        struct(("b", T.IntegerType()), ("a", T.StringType())),
    )
    assert out.columns == ["b", "a", "extra"]
    assert out.first().asDict() == {"b": 1, "a": "x", "extra": True}


def test_rename_refuses_different_lengths(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="cannot rename"):
        rename_by_position(df, df.schema, struct(("a", T.IntegerType()), ("b", T.IntegerType())))


def test_layer_schemas_line_up_by_position():
    for raw, trusted in ((RAW_WEATHER, TRUSTED_WEATHER), (RAW_TRAFFIC, TRUSTED_TRAFFIC)):
        assert [f.dataType for f in raw.schema] == [f.dataType for f in trusted.schema]
        assert set(raw.required) | set(raw.optional) == set(raw.schema.names)


def test_conform_orders_casts_and_drops(spark):
    df = spark.createDataFrame([("7", 1.5, "z")], "b string, a double, c string")
    out = conform(df, struct(("a", T.FloatType()), ("b", T.IntegerType())))
    assert out.schema == struct(("a", T.FloatType()), ("b", T.IntegerType()))
    assert tuple(out.first()) == (1.5, 7)


def test_conform_is_strict_unless_lenient(spark):
    df = spark.createDataFrame([("x",)], "b string")
    target = struct(("b", T.IntegerType()))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, target).collect()
    assert conform(df, target, lenient=True).first()["b"] is None


def test_whole_truncates_towards_zero(spark):
    df = spark.createDataFrame([(10.7,), (-10.7,), (1e12,), (float("nan"),), (None,)], "x double")
    out = df.select(whole(F.col("x"), T.IntegerType())).collect()
    assert [r[0] for r in out] == [10, -10, None, None, None]


def test_first_of_empty_array_is_null(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "x array<int>")
    assert [r[0] for r in df.select(first(F.col("x"))).collect()] == [1, None, None]


def test_composite_key_needs_every_part(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (None, 2)], "a int, b int")
    keys = df.select(composite_key(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in keys] == ["1_2", None, None]


def test_nested_to_json_covers_every_nested_column(spark):
    df = spark.createDataFrame(
        [(1, [{"a": "ü\"x"}], {"k": 1}, (2,))], "id int, l array<map<string,string>>, m map<string,int>, s struct<v:int>"
    )
    row = nested_to_json(df).first()
    assert row["id"] == 1
    assert json.loads(row["l"]) == [{"a": 'ü"x'}]
    assert json.loads(row["m"]) == {"k": 1}
    assert json.loads(row["s"]) == {"v": 2}


def test_nested_to_json_leaves_flat_tables_alone(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert nested_to_json(df) is df


@pytest.mark.parametrize(
    ("name", "folded"),
    [
        ("Москва", "moskva"), ("ЩЁЛКОВО", "shchelkovo"), ("Нижний Новгород", "nizhnii novgorod"),
        ("Пльзень", "plzen"), ("Ґданськ", "gdansk"), ("Київ", "kiiv"), ("Ќе Ѓорче", "ke gorche"), ("Љубљана", "ljubljana"),
        ("Αθήνα", "athina"), ("ΘΕΣΣΑΛΟΝΊΚΗ", "thessaloniki"), ("Ναύπλιο", "nafplio"), ("Εύβοια", "evvoia"),
        ("Μπάρι", "bari"), ("Λαμπρός", "lampros"), ("Αγγελόκαστρο", "angelokastro"), ("Ούγια", "ougia"),
        ("Ψαχνά Χίος", "psachna chios"), ("Ὀλυμπία", "olympia"), ("Ηράκλειο São", "irakleio sao"), ("Λευκάδα", "lefkada"),
        ("東京", "東京"), ("Straße", "strasse"), ("İzmir", "izmir"),
    ],
)
def test_names_in_other_scripts_fold_to_their_romanisation(spark, name, folded):
    assert spark.createDataFrame([(name,)], "n string").select(fold(F.col("n"))).first()[0] == folded
