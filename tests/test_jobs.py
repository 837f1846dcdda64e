"""Raw load, promotion, enrichment and star schema on hand-written payloads."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from payloads import DAY, NOON, directions, landed, leg, weather

from tierflow.plans import promotion, raw_load, star
from tierflow.plans.enrichment import MissingWeather, describe_routes
from tierflow.plans.promotion import promote_routes, promote_weather
from tierflow.plans.raw_load import RejectedRows, load_routes, load_weather
from tierflow.sinks.files import publish_snapshot, read_snapshot, snapshots
from tierflow.sources.tables import open_merged, open_table, typed_rows
from tierflow.specs import (
    CITY_DIM, RAW_TRAFFIC, RAW_WEATHER, ROUTE_DESCRIPTION, ROUTE_DIM, ROUTE_FACT, STEP_FACT,
    TRUSTED_WEATHER, WEATHER_DIM,
)

LOAD_TS = NOON + 50


def table(spark, spec, base):
    return open_table(spark, spec.path(base), spec.schema)


def current(spark, spec, base):
    return read_snapshot(spark, spec.path(base), spec.schema)


def rejects(spark, spec, base):
    return open_table(spark, spec.quarantine_path(base), "reason string, payload string, batch_id string") \
        if os.path.exists(spec.quarantine_path(base)) else None


def files(path):
    return {
        os.path.join(where, name): os.path.getmtime(os.path.join(where, name))
        for where, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


# --- raw load ---------------------------------------------------------------------


def test_first_load_needs_no_table(spark, base_dir):
    assert table(spark, RAW_WEATHER, base_dir).collect() == []
    report = load_weather(landed(spark, weather(1), weather(2, "Lavras")), base_dir, "b1")
    assert report.accepted == 2 and report.rejected == {} and report.partitions == ("2024-06-01",)
    raw = table(spark, RAW_WEATHER, base_dir)
    assert raw.schema == RAW_WEATHER.schema
    assert {r["city"] for r in raw.collect()} == {"Resende", "Lavras"}


def test_upsert_keeps_the_highest_version_and_is_idempotent(spark, base_dir):
    newer = weather(1, main={"temp": 30})
    load_weather(landed(spark, weather(1), weather(2)), base_dir, "b1")
    load_weather(landed(spark, weather(1, dt=NOON - 60, main={"temp": 1}), newer), base_dir, "b2")
    once = sorted(map(tuple, table(spark, RAW_WEATHER, base_dir).collect()))
    assert {(r[0], r[6]) for r in once} == {(1, 30.0), (2, 21.5)}  # equal version: incoming wins
    load_weather(landed(spark, weather(1, dt=NOON - 60, main={"temp": 1}), newer), base_dir, "b2")
    assert sorted(map(tuple, table(spark, RAW_WEATHER, base_dir).collect())) == once


def test_late_rows_merge_into_their_own_partition(spark, base_dir):
    load_weather(landed(spark, weather(1, dt=NOON - DAY), weather(2, dt=NOON - DAY), weather(1)), base_dir, "b1")
    before = files(f"{RAW_WEATHER.path(base_dir)}/dt=2024-06-01")
    report = load_weather(landed(spark, weather(3, dt=NOON - DAY)), base_dir, "late")
    assert report.partitions == ("2024-05-31",)
    rows = {(r["id"], r["dt"]) for r in table(spark, RAW_WEATHER, base_dir).collect()}
    assert rows == {(1, "2024-05-31"), (2, "2024-05-31"), (3, "2024-05-31"), (1, "2024-06-01")}
    assert files(f"{RAW_WEATHER.path(base_dir)}/dt=2024-06-01") == before  # untouched


def test_permuted_input_gives_the_same_table(spark, base_dir):
    batch = [weather(1, main={"temp": t}) for t in (1, 2, 3)] + [weather(2)]
    load_weather(landed(spark, *batch), f"{base_dir}/a", "b")
    load_weather(landed(spark, *reversed(batch)), f"{base_dir}/b", "b")
    a, b = (sorted(map(tuple, table(spark, RAW_WEATHER, f"{base_dir}/{x}").collect())) for x in "ab")
    assert a == b and len(a) == 2


def test_quarantine_keeps_every_rejected_payload(spark, base_dir):
    batch = [weather(1), "{bad", {"dt": NOON}, weather(2), {"id": 5}]
    report = load_weather(landed(spark, *batch), base_dir, "b1")
    assert report.accepted == 2
    assert report.rejected == {"corrupt": 1, "null_id": 1, "null_dt": 1}
    kept = rejects(spark, RAW_WEATHER, base_dir).collect()
    assert {(r["reason"], r["payload"]) for r in kept} == {
        ("corrupt", "{bad"), ("null_id", json.dumps({"dt": NOON})), ("null_dt", '{"id": 5}')
    }
    load_weather(landed(spark, *batch), base_dir, "b1")  # again: replaced, not appended
    assert rejects(spark, RAW_WEATHER, base_dir).count() == 3
    load_weather(landed(spark, "{worse"), base_dir, "b2")
    assert rejects(spark, RAW_WEATHER, base_dir).count() == 4


def test_strict_load_writes_nothing(spark, base_dir):
    with pytest.raises(RejectedRows, match="corrupt"):
        load_routes(landed(spark, directions(), "{bad"), base_dir, "b1", NOON)
    assert not os.path.exists(RAW_TRAFFIC.path(base_dir))
    assert not os.path.exists(RAW_TRAFFIC.quarantine_path(base_dir))


def test_unknown_policy_is_refused(spark, base_dir):
    with pytest.raises(ValueError, match="on_error"):
        load_weather(landed(spark, weather()), base_dir, "b", on_error="ignore")


def test_only_rejects_leaves_the_table_absent(spark, base_dir):
    report = load_weather(landed(spark, "{bad"), base_dir, "b1")
    assert report.partitions == () and not os.path.exists(RAW_WEATHER.path(base_dir))


def test_first_route_alternative_wins(spark, base_dir):
    body = directions(routes=[{"legs": [leg(1000)]}, {"legs": [leg(2000)]}, {"legs": [leg(3000)]}])
    load_routes(landed(spark, body), base_dir, "b1", NOON)
    rows = table(spark, RAW_TRAFFIC, base_dir).collect()
    assert [(r["route_uuid"], r["travel_distance"]) for r in rows] == [("1_2", 1000)]


def test_upsert_reads_touched_partitions_only(spark, base_dir):
    load_weather(landed(spark, *[weather(1, dt=NOON - i * DAY) for i in range(5)]), base_dir, "b1")
    stored = raw_load.stored_partitions(spark, RAW_WEATHER, base_dir, ["2024-05-30"])
    text = stored._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in text or "PartitionFilters: [dt" in text
    assert len(stored.inputFiles()) >= 1 and stored.count() == 1


# --- promotion --------------------------------------------------------------------


def test_promotion_translates_and_keeps_latest(spark, base_dir):
    load_weather(landed(spark, weather(1, dt=NOON - DAY, main={"temp": 1}), weather(1), weather(2, dt=NOON - DAY)), base_dir, "b1")
    done = promote_weather(spark, base_dir, "b1")
    assert (done.snapshot, done.rows_read, done.rows_rejected) == (1, 3, 0)
    trusted = current(spark, TRUSTED_WEATHER, base_dir)
    assert trusted.schema == TRUSTED_WEATHER.schema
    assert {(r["nu_cidade"], r["temperatura"], r["dt"]) for r in trusted.collect()} == {
        (1, 21.5, "2024-06-01"), (2, 21.5, "2024-05-31"),
    }


def test_promotion_again_reads_its_own_table(spark, base_dir):
    load_weather(landed(spark, weather(1)), base_dir, "b1")
    first = promote_weather(spark, base_dir, "b1")
    rows = current(spark, TRUSTED_WEATHER, base_dir).collect()
    second = promote_weather(spark, base_dir, "b1")
    assert (first.snapshot, second.snapshot) == (1, 2)
    assert current(spark, TRUSTED_WEATHER, base_dir).collect() == rows


def test_promotion_of_changed_dates_equals_a_full_one(spark, base_dir):
    load_weather(landed(spark, *[weather(i, dt=NOON - DAY) for i in range(1, 5)]), base_dir, "b1")
    promote_weather(spark, base_dir, "b1")
    report = load_weather(landed(spark, weather(2, main={"temp": 9}), weather(7)), base_dir, "b2")
    part = promote_weather(spark, base_dir, "b2", dates=report.partitions)
    assert part.rows_read == 2
    partial = sorted(map(tuple, current(spark, TRUSTED_WEATHER, base_dir).collect()))
    promote_weather(spark, base_dir, "b2")
    assert sorted(map(tuple, current(spark, TRUSTED_WEATHER, base_dir).collect())) == partial
    assert len(partial) == 5


def test_incomplete_rows_are_rejected_at_promotion(spark, base_dir):
    batch = [weather(1), weather(2, weather=[]), weather(3, name=None, visibility=None)]
    load_weather(landed(spark, *batch), base_dir, "b1")
    assert table(spark, RAW_WEATHER, base_dir).count() == 3
    done = promote_weather(spark, base_dir, "b1")
    assert (done.rows_read, done.rows_rejected) == (3, 2)
    assert [r["nu_cidade"] for r in current(spark, TRUSTED_WEATHER, base_dir).collect()] == [1]
    kept = rejects(spark, TRUSTED_WEATHER, base_dir).collect()
    assert {r["reason"] for r in kept} == {"missing:weather_description", "missing:city"}
    assert {json.loads(r["payload"])["id"] for r in kept} == {2, 3}


def test_strict_promotion_publishes_nothing(spark, base_dir):
    load_weather(landed(spark, weather(2, weather=[])), base_dir, "b1")
    with pytest.raises(RejectedRows, match="1 rows"):
        promote_weather(spark, base_dir, "b1", on_error="fail")
    assert snapshots(spark, TRUSTED_WEATHER.path(base_dir)) == ([], 1)


def test_absent_measurements_stop_at_promotion_without_defaults(spark, base_dir):
    bare = weather(1, main={"temp": 20})
    load_weather(landed(spark, bare), f"{base_dir}/zero", "b")
    load_weather(landed(spark, bare), f"{base_dir}/null", "b", defaults=False)
    assert promote_weather(spark, f"{base_dir}/zero", "b").rows_rejected == 0
    assert promote_weather(spark, f"{base_dir}/null", "b").rows_rejected == 1


def test_incomplete_snapshot_is_ignored(spark, base_dir):
    path = TRUSTED_WEATHER.path(base_dir)
    load_weather(landed(spark, weather(1)), base_dir, "b1")
    promote_weather(spark, base_dir, "b1")
    os.makedirs(f"{path}/snapshot_id=2")  # a writer died before its commit
    assert snapshots(spark, path) == ([1], 3)
    assert current(spark, TRUSTED_WEATHER, base_dir).count() == 1
    assert publish_snapshot(current(spark, TRUSTED_WEATHER, base_dir), path) == 3


def test_long_promotion_plan_is_planned_quickly(spark, base_dir):
    """Renaming 22 columns behind a filter on 18 must not blow up the optimizer."""
    import time

    load_weather(landed(spark, weather(1)), base_dir, "b1")
    history = promotion.weather_history(spark, base_dir)
    merged = promotion.merge_trusted(
        current(spark, TRUSTED_WEATHER, base_dir), history, TRUSTED_WEATHER, history.select("nu_cidade")
    )
    start = time.time()
    merged._jdf.queryExecution().executedPlan()
    assert time.time() - start < 5


# --- enrichment -------------------------------------------------------------------


def zone(spark, base_dir, readings, routes):
    load_weather(landed(spark, *readings), base_dir, "b1")
    load_routes(landed(spark, *routes), base_dir, "b1", NOON)
    promote_weather(spark, base_dir, "b1")
    promote_routes(spark, base_dir, "b1")


def test_each_role_gets_its_own_weather(spark, base_dir):
    readings = [weather(9, "Resende", main={"temp": 10, "sea_level": 5}), weather(2, "Lavras", main={"temp": 30})]
    routes = [directions((9, "Resende"), (2, "Lavras")), directions((2, "Lavras"), (9, "Resende")),
              directions((2, "Lavras"), (2, "Lavras"))]
    zone(spark, base_dir, readings, routes)
    done = describe_routes(spark, base_dir, "b1", LOAD_TS)
    assert (done.snapshot, done.missing) == (1, 0)
    out = current(spark, ROUTE_DESCRIPTION, base_dir)
    assert out.schema == ROUTE_DESCRIPTION.schema
    rows = {r["nu_rota"]: r for r in out.collect()}
    assert {k: (r["temp_origem"], r["temp_destino"]) for k, r in rows.items()} == {
        "9_2": (10.0, 30.0), "2_9": (30.0, 10.0), "2_2": (30.0, 30.0),
    }
    row = rows["9_2"]
    assert (row["origem"], row["destino"]) == ("Resende", "Lavras")
    assert (row["ponto_partida"], row["ponto_chegada"]) == ("A", "B")
    assert (row["altitude_origem"], row["altitude_destino"]) == (5, None)
    assert (row["descricao_tempo_origem"], row["distancia"], row["duracao"]) == ("nublado", 1000, 600)
    assert (row["dt_carga"], row["dt"]) == (LOAD_TS, "2024-06-01")
    assert len(row["passos"]) == 2


def test_route_finds_weather_of_its_date_after_newer_weather_arrived(spark, base_dir):
    zone(spark, base_dir, [weather(1, main={"temp": 10}), weather(2, main={"temp": 11})], [directions()])
    load_weather(landed(spark, weather(1, dt=NOON + DAY, main={"temp": 99}), weather(2, dt=NOON + DAY)), base_dir, "b2")
    promote_weather(spark, base_dir, "b2")
    describe_routes(spark, base_dir, "b2", LOAD_TS)
    row = current(spark, ROUTE_DESCRIPTION, base_dir).first()
    assert (row["temp_origem"], row["temp_destino"]) == (10.0, 11.0)


def test_missing_weather_stops_a_strict_job(spark, base_dir):
    zone(spark, base_dir, [weather(1)], [directions(), directions((1, "Resende"), (3, "Itu"))])
    with pytest.raises(MissingWeather, match="2 cities.*Itu|2 cities.*Lavras"):
        describe_routes(spark, base_dir, "b1", LOAD_TS)
    assert snapshots(spark, ROUTE_DESCRIPTION.path(base_dir)) == ([], 1)


def test_missing_weather_sets_routes_aside(spark, base_dir):
    routes = [directions((1, "Resende"), (1, "Resende")), directions(), directions((2, "Lavras"), (1, "Resende")),
              directions((2, "Lavras"), (3, "Itu"))]
    zone(spark, base_dir, [weather(1)], routes)
    done = describe_routes(spark, base_dir, "b1", LOAD_TS, on_missing="quarantine")
    assert done.missing == 2
    assert [r["nu_rota"] for r in current(spark, ROUTE_DESCRIPTION, base_dir).collect()] == ["1_1"]
    kept = {json.loads(r["payload"])["nu_rota"]: r["reason"] for r in rejects(spark, ROUTE_DESCRIPTION, base_dir).collect()}
    assert kept == {
        "1_2": "no_weather:destino", "2_1": "no_weather:origem", "2_3": "no_weather:origem,destino",
    }


def test_description_merges_with_earlier_ones(spark, base_dir):
    zone(spark, base_dir, [weather(1), weather(2)], [directions()])
    describe_routes(spark, base_dir, "b1", LOAD_TS)
    load_routes(landed(spark, directions((2, "Lavras"), (1, "Resende"))), base_dir, "b2", NOON + 5)
    promote_routes(spark, base_dir, "b2")
    describe_routes(spark, base_dir, "b2", LOAD_TS + 5)
    describe_routes(spark, base_dir, "b2", LOAD_TS + 5)
    rows = current(spark, ROUTE_DESCRIPTION, base_dir).collect()
    assert {(r["nu_rota"], r["dt_carga"]) for r in rows} == {("1_2", LOAD_TS + 5), ("2_1", LOAD_TS + 5)}
    assert snapshots(spark, ROUTE_DESCRIPTION.path(base_dir))[0] == [1, 2, 3]


# --- star schema ------------------------------------------------------------------


def test_star_schema(spark, base_dir):
    zone(spark, base_dir, [weather(1, dt=NOON - DAY), weather(1), weather(2, "Lavras")],
         [directions(), directions((1, "Resende"), (3, "Itu"))])
    star.build_star(spark, base_dir)
    cities = current(spark, CITY_DIM, base_dir)
    assert cities.schema == CITY_DIM.schema
    assert {(r["nu_cidade"], r["cidade"], r["dt"]) for r in cities.collect()} == {
        (1, "Resende", "2024-06-01"), (2, "Lavras", "2024-06-01"),
    }
    climate = table(spark, WEATHER_DIM, base_dir)
    assert {r["nu_clima"] for r in climate.collect()} == {f"1_{NOON - DAY}", f"1_{NOON}", f"2_{NOON}"}
    routes = current(spark, ROUTE_DIM, base_dir).collect()
    assert {(r["nu_rota"], r["dt_carga"], r["dt"]) for r in routes} == {
        ("1_2", date(2024, 6, 1), date(2024, 6, 1)), ("1_3", date(2024, 6, 1), date(2024, 6, 1)),
    }
    facts = {r["nu_rota"]: r for r in table(spark, ROUTE_FACT, base_dir).collect()}
    assert facts["1_2"]["nu_clima_origem"] == f"1_{NOON}" and facts["1_2"]["nu_clima_destino"] == f"2_{NOON}"
    assert facts["1_3"]["nu_clima_destino"] is None and facts["1_2"]["duracao"] == 600
    lists = table(spark, STEP_FACT, base_dir)
    assert {r["nu_passo"] for r in lists.collect()} == {f["nu_passo"] for f in facts.values()}
    laid = star.steps(lists).where("nu_passo = '1_2_2024-06-01'").orderBy("pos").collect()
    assert [(r["pos"], r["passo"]["html_instructions"]) for r in laid] == [(0, "vire à direita"), (1, "siga")]


def test_star_of_one_date_leaves_other_dates(spark, base_dir):
    zone(spark, base_dir, [weather(1), weather(2)], [directions()])
    star.build_star(spark, base_dir)
    load_weather(landed(spark, weather(1, dt=NOON + DAY), weather(2, dt=NOON + DAY)), base_dir, "b2")
    load_routes(landed(spark, directions()), base_dir, "b2", NOON + DAY)
    before = files(f"{ROUTE_FACT.path(base_dir)}/dt=2024-06-01")
    star.build_star(spark, base_dir, dates=["2024-06-02"])
    assert files(f"{ROUTE_FACT.path(base_dir)}/dt=2024-06-01") == before
    assert {str(r["dt"]) for r in table(spark, ROUTE_FACT, base_dir).collect()} == {"2024-06-01", "2024-06-02"}


# --- scans ------------------------------------------------------------------------


def test_partition_values_keep_their_declared_type(spark, base_dir):
    load_weather(landed(spark, weather(1)), base_dir, "b1")
    assert dict(table(spark, RAW_WEATHER, base_dir).dtypes)["dt"] == "string"


def test_merged_schema_scan(spark, base_dir):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{base_dir}/t/x=1")
    spark.createDataFrame([("u",)], "b string").write.parquet(f"{base_dir}/t/x=2")
    rows = open_merged(spark, f"{base_dir}/t").select("a", "b").collect()
    assert {tuple(r) for r in rows} == {(1, None), (None, "u")}


def test_typed_rows_are_checked(spark):
    assert typed_rows(spark, [(None,) * len(CITY_DIM.schema)], CITY_DIM.schema).schema == CITY_DIM.schema
    with pytest.raises(Exception, match="CANNOT_ACCEPT|can not accept|FIELD_DATA_TYPE"):
        typed_rows(spark, [("x", *(None,) * (len(CITY_DIM.schema) - 1))], CITY_DIM.schema)


# --- empty batches and reruns -------------------------------------------------------


def test_a_batch_of_rejects_only_changes_nothing(spark, base_dir):
    report = load_weather(landed(spark, "{not json"), base_dir, "b1")
    assert report.accepted == 0 and report.partitions == ()
    done = promote_weather(spark, base_dir, "b1", dates=report.partitions)
    assert (done.snapshot, done.rows_read, done.rows_rejected) == (0, 0, 0)
    assert snapshots(spark, TRUSTED_WEATHER.path(base_dir)) == ([], 1)


def test_a_mended_batch_leaves_no_old_rejects(spark, base_dir):
    load_weather(landed(spark, weather(1), "{not json"), base_dir, "b=1/x")
    assert rejects(spark, RAW_WEATHER, base_dir).count() == 1
    load_weather(landed(spark, weather(1)), base_dir, "b=1/x")
    left = rejects(spark, RAW_WEATHER, base_dir)
    assert left is None or left.count() == 0


def test_all_missing_cities_are_listed_once_each(spark, base_dir):
    routes = [directions((1, "Resende"), (3, "Itu")), directions((3, "ITU"), (1, "Resende"))]
    zone(spark, base_dir, [weather(1)], routes)
    with pytest.raises(MissingWeather, match="1 cities.*batch_id=b1"):
        describe_routes(spark, base_dir, "b1", LOAD_TS)
    listed = spark.read.parquet(f"{ROUTE_DESCRIPTION.quarantine_path(base_dir)}_missing")
    assert [(r["nu_cidade"], r["name"]) for r in listed.collect()] == [(3, "ITU")]
