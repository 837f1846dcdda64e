"""Incremental enrichment, payload accounts, retention, orphan reports and route requests."""

from __future__ import annotations

import json
import os
import uuid

import pytest
from conftest import plan_of
from payloads import DAY, NOON, directions, landed, leg, weather
from pyspark.sql import functions as F

from tierflow.operators.sizing import sized
from tierflow.plans import enrichment, promotion, raw_load, star
from tierflow.plans.enrichment import MissingWeather, describe_routes, routes_to_describe
from tierflow.plans.promotion import promote_routes, promote_weather, weather_history
from tierflow.plans.raw_load import (
    RejectedRows, account_path, load_routes, load_weather, stored_partitions,
)
from tierflow.plans.requests import UnresolvedCities, request_routes
from tierflow.sinks.files import expire_snapshots, publish_snapshot, read_snapshot, snapshots
from tierflow.sources import scratch
from tierflow.sources.scratch import job_scratch, staged
from tierflow.specs import (
    RAW_TRAFFIC, RAW_WEATHER, ROUTE_DESCRIPTION, ROUTE_REQUEST, TRUSTED_TRAFFIC,
)
from tierflow.workload import standins

LOAD_TS = NOON + 50


@pytest.fixture
def scratch_dir(base_dir, monkeypatch):
    """A scratch folder that can be looked into."""
    monkeypatch.setattr(
        scratch, "scratch_path", lambda spark, purpose: f"{base_dir}/scratch/{purpose}-{uuid.uuid4().hex}"
    )
    return f"{base_dir}/scratch"


def described(spark, base):
    rows = read_snapshot(spark, ROUTE_DESCRIPTION.path(base), ROUTE_DESCRIPTION.schema).collect()
    return {r["nu_rota"]: (r["temp_origem"], r["temp_destino"], r["distancia"], r["dt"], r["dt_carga"]) for r in rows}


def steps(spark, base, second):
    """Two loads of weather and routes; ``second`` describes the second run."""
    load_weather(landed(spark, weather(1), weather(2), weather(1, dt=NOON + DAY)), base, "b1")
    load_routes(landed(spark, directions(), directions((2, "Lavras"), (1, "Resende"))), base, "b1", NOON)
    load_routes(landed(spark, directions((1, "Resende"), (3, "Itu"))), base, "b1b", NOON + DAY)
    promote_routes(spark, base, "b1")
    first = describe_routes(spark, base, "b1", LOAD_TS, on_missing="quarantine")
    late = load_weather(landed(spark, weather(3, "Itu", dt=NOON + DAY, main={"temp": 7})), base, "b2")
    changed = load_routes(landed(spark, directions(routes=[{"legs": [leg(5000)]}])), base, "b2", NOON + 9)
    promote_routes(spark, base, "b2", dates=changed.dates)
    return first, second(first, late)


def test_an_incremental_run_gives_the_table_of_a_full_one(spark, base_dir):
    a, b = f"{base_dir}/a", f"{base_dir}/b"
    first, part = steps(spark, a, lambda first, late: describe_routes(
        spark, a, "b2", LOAD_TS + 1, since=first.routes, weather_dates=late.dates))
    _, full = steps(spark, b, lambda first, late: describe_routes(spark, b, "b2", LOAD_TS + 1))
    assert first.described == 3 and (first.missing, first.routes) == (1, 1)
    assert (part.described, full.described) == (2, 3) and part.routes == 2
    got, want = described(spark, a), described(spark, b)
    assert {k: v[:4] for k, v in got.items()} == {k: v[:4] for k, v in want.items()}
    assert {k: v[4] for k, v in got.items()} == {"1_2": LOAD_TS + 1, "1_3": LOAD_TS + 1, "2_1": LOAD_TS}
    assert got["1_3"][:2] == (21.5, 7.0) and got["1_2"][2] == 5000


def test_an_increment_without_changes_describes_nothing(spark, base_dir):
    first, again = steps(spark, base_dir, lambda first, late: describe_routes(
        spark, base_dir, "b2", LOAD_TS + 1, since=first.routes, weather_dates=late.dates))
    before = described(spark, base_dir)
    idle = describe_routes(spark, base_dir, "b3", LOAD_TS + 2, since=again.routes)
    assert idle.described == 0 and described(spark, base_dir) == before


def test_a_strict_increment_looks_at_its_own_routes_only(spark, base_dir):
    first, _ = steps(spark, base_dir, lambda first, late: None)
    load_routes(landed(spark, directions((2, "Lavras"), (9, "Nada"))), base_dir, "b3", NOON)
    promote_routes(spark, base_dir, "b3")
    newest = snapshots(spark, TRUSTED_TRAFFIC.path(base_dir))[0]
    with pytest.raises(MissingWeather, match="Nada"):
        describe_routes(spark, base_dir, "b3", LOAD_TS + 2, since=newest[-2])


def test_an_expired_start_means_a_full_run(spark, base_dir):
    first, _ = steps(spark, base_dir, lambda first, late: None)
    path = TRUSTED_TRAFFIC.path(base_dir)
    assert expire_snapshots(spark, path, 1) == [1]
    routes = read_snapshot(spark, path, TRUSTED_TRAFFIC.schema)
    assert routes_to_describe(spark, base_dir, routes, first.routes).count() == routes.count() == 3


def test_only_touched_dates_are_scanned(spark, base_dir):
    load_weather(landed(spark, *[weather(1, dt=NOON + i * DAY) for i in range(6)]), base_dir, "b1")
    dates = sized(spark.createDataFrame([("2024-06-03",), ("2024-06-05",)], "dt string"), "dates")
    for scan in (weather_history(spark, base_dir, dates), stored_partitions(spark, RAW_WEATHER, base_dir, dates)):
        assert "dynamicpruning" in plan_of(scan).lower()
        assert sorted(r["dt"] for r in scan.collect()) == ["2024-06-03", "2024-06-05"]
        metrics = scan._jdf.queryExecution().executedPlan()
        assert "dt" in metrics.toString()


# --- accounts -------------------------------------------------------------------------


def test_accepted_and_rejected_payloads_are_all_that_was_landed(spark, base_dir):
    batch = [directions(), directions(routes=[]), {"status": "OVER_QUERY_LIMIT"}, {"status": "OVER_QUERY_LIMIT"},
             "{bad", directions((1, "Resende"), (3, "Itu"))]
    report = load_routes(landed(spark, *batch), base_dir, "b1", NOON, on_error="quarantine")
    assert report.payloads == {"accepted": 2, "no_routes": 3, "corrupt": 1}
    assert sum(report.payloads.values()) == len(batch) and report.accepted == 2
    kept = spark.read.parquet(RAW_TRAFFIC.quarantine_path(base_dir)).collect()
    assert sorted(r["payload"] for r in kept if r["reason"] == "no_routes") == sorted(
        json.dumps(b, ensure_ascii=False) for b in batch[1:4]
    )
    load_routes(landed(spark, *batch), base_dir, "b1", NOON, on_error="quarantine")  # again: replaced
    account = spark.read.parquet(account_path(RAW_TRAFFIC, base_dir))
    assert account.where("outcome = 'no_routes'").agg({"payloads": "sum"}).first()[0] == 3


def test_a_strict_load_records_payloads_without_routes(spark, base_dir):
    report = load_routes(landed(spark, directions(), directions(routes=[])), base_dir, "b1", NOON)
    assert (report.accepted, report.rejected) == (1, {"no_routes": 1})
    assert spark.read.parquet(RAW_TRAFFIC.quarantine_path(base_dir)).count() == 1
    with pytest.raises(RejectedRows):
        load_routes(landed(spark, "{bad"), base_dir, "b2", NOON)


# --- retention ------------------------------------------------------------------------


def test_old_snapshots_expire_and_the_newest_stays(spark, base_dir):
    path, df = f"{base_dir}/t", spark.range(3)
    assert expire_snapshots(spark, path, 1) == []
    for _ in range(4):
        publish_snapshot(df, path)
    os.remove(f"{path}/snapshot_id=2/_SUCCESS")  # a writer that died
    os.makedirs(f"{path}/snapshot_id=5")  # a write in progress
    assert expire_snapshots(spark, path, 2) == [1, 2]
    assert snapshots(spark, path) == ([3, 4], 6)
    assert expire_snapshots(spark, path, 1) == [3] and expire_snapshots(spark, path, 1) == []
    assert read_snapshot(spark, path, df.schema).count() == 3
    with pytest.raises(ValueError, match="newest"):
        expire_snapshots(spark, path, 0)
    with pytest.raises(ValueError, match="no complete snapshot 1"):
        read_snapshot(spark, path, df.schema, 1)


def test_jobs_remove_what_they_staged(spark, base_dir, scratch_dir):
    report = load_weather(landed(spark, weather(1), weather(2)), base_dir, "b1")
    left = os.listdir(scratch_dir)
    assert [n.rsplit("-", 1)[0] for n in left] == ["dates"]  # handed out with the report
    assert report.partitions == ("2024-06-01",)
    load_routes(landed(spark, directions((1, "Resende"), (3, "Itu"))), base_dir, "b1", NOON)
    promote_weather(spark, base_dir, "b1")
    promote_routes(spark, base_dir, "b1")
    star.build_star(spark, base_dir)
    with pytest.raises(MissingWeather):
        describe_routes(spark, base_dir, "b1", LOAD_TS)
    assert {n.rsplit("-", 1)[0] for n in os.listdir(scratch_dir)} == {"dates"}


def test_scratch_of_a_failed_job_goes_too(spark, scratch_dir):
    with pytest.raises(KeyError), job_scratch(spark):
        staged(spark.range(2), "lost")
        kept = staged(spark.range(2), "kept", keep=True)
        raise KeyError
    assert [n.rsplit("-", 1)[0] for n in os.listdir(scratch_dir)] == ["kept"] and kept.count() == 2


# --- orphans --------------------------------------------------------------------------


def test_star_job_lists_orphans_of_the_fact(spark, base_dir):
    load_weather(landed(spark, weather(1), weather(2)), base_dir, "b1")
    routes = [directions(), directions((1, "Resende"), (3, "Itu"))]
    load_routes(landed(spark, *routes), base_dir, "b1", NOON)
    promote_weather(spark, base_dir, "b1")
    promote_routes(spark, base_dir, "b1")
    assert star.build_star(spark, base_dir) == 2
    schema = "dt date, column string, dimension string, key string, rows long"
    lost = read_snapshot(spark, star.orphan_path(base_dir), spark.createDataFrame([], schema).schema).collect()
    assert {(r["column"], r["dimension"], r["key"], r["rows"]) for r in lost} == {
        ("nu_cidade_destino", "dm_cidade", "3", 1), ("nu_clima_destino", "dm_clima", None, 1),
    }
    load_weather(landed(spark, weather(3, "Itu")), base_dir, "b2")
    promote_weather(spark, base_dir, "b2")
    assert star.build_star(spark, base_dir) == 0


# --- requests -------------------------------------------------------------------------


def test_city_pairs_become_requests(spark, base_dir):
    load_weather(landed(spark, weather(1, "São José"), weather(2, "Lavras"), weather(4, "Bom Jesus"), weather(5, "BOM JESUS")), base_dir, "b1")
    pairs = [("sao jose", "LAVRAS", "2024-06-01"), ("sao jose", "LAVRAS", "2024-06-01"), ("Lavras", "bom jesus", "2024-06-01"),
             ("Lavras", "Itu", "2024-06-01"), ("Lavras", "Lavras", "2024-06-02"), (None, "Lavras", "2024-06-01")]
    asked = spark.createDataFrame(pairs, "origin string, destination string, dt string")
    with pytest.raises(UnresolvedCities, match="4 requests"):
        request_routes(asked, base_dir, "b1")
    assert not os.path.exists(ROUTE_REQUEST.path(base_dir))
    done = request_routes(asked, base_dir, "b1", on_error="quarantine")
    assert done.statuses == {"resolved": 1, "ambiguous": 1, "missing": 3}
    made = spark.read.parquet(ROUTE_REQUEST.path(base_dir)).collect()
    assert [(r["route_uuid"], r["origin_city"], r["destination_city"]) for r in made] == [("1_2", "São José", "Lavras")]
    assert spark.read.parquet(ROUTE_REQUEST.quarantine_path(base_dir)).count() == 4
    assert request_routes(asked.limit(1), base_dir, "b1").statuses == {"resolved": 1}  # mended
    assert not os.path.exists(f"{ROUTE_REQUEST.quarantine_path(base_dir)}/batch_id=b1")
    assert request_routes(asked.limit(0), base_dir, "b1").statuses == {}
    assert not os.path.exists(f"{ROUTE_REQUEST.path(base_dir)}/batch_id=b1")


def test_events_are_dealt_evenly_and_a_first_run_stages_no_keys(spark, base_dir, monkeypatch):
    rows = [(i, f"2024-01-0{1 + i % 5} 10:00:0{i % 10}", i % 6, "view", float(i), f'{{"k": {i % 7}}}') for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, at string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.to_timestamp_ntz("at")).drop("at").coalesce(1).write.parquet(f"{base_dir}/sf/events.parquet")
    weather, routes = standins.event_weather(spark, f"{base_dir}/sf"), standins.event_routes(spark, f"{base_dir}/sf")
    assert weather.rdd.getNumPartitions() == routes.rdd.getNumPartitions() == 4  # one file, one row group

    purposes = []
    for module in (raw_load, promotion, enrichment):
        monkeypatch.setattr(module, "sized", lambda df, purpose, **k: purposes.append(purpose) or sized(df, purpose, **k))

    def run(batch: str) -> list:
        assert load_weather(weather, base_dir, batch).payloads == {"accepted": 60}
        assert load_routes(routes, base_dir, batch, F.col("epoch")).payloads == {"accepted": 60}
        promotion.promote_routes(spark, base_dir, batch)
        done = enrichment.describe_routes(spark, base_dir, batch, 7, on_missing="quarantine")
        assert done.described == 42
        path = ROUTE_DESCRIPTION.path(base_dir)
        return sorted(map(str, read_snapshot(spark, path, ROUTE_DESCRIPTION.schema).collect()))

    first = run("first")
    assert first and not {"changed-keys", "routes"} & set(purposes)
    assert run("again") == first and "changed-keys" in purposes
    empty = load_weather(weather.where("payload is null"), base_dir, "first")
    assert empty.payloads == {} and empty.accepted == 0
