from __future__ import annotations

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tierflow.operators.lookup import (
    attach_twice, city_names, missing_references, resolve_city_pairs,
)
from tierflow.operators.latest import merge_changed
from tierflow.operators.sizing import Sized, broadcast_within, sized

D = "2024-06-01"
ROLES = {"a": "o", "b": "d"}


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(
        [(1, "São José", D), (2, "Lavras", D), (3, "Straße", D), (4, "Bom Jesus", D), (5, "BOM JESUS", D),
         (2, "Lavras", "2024-06-02"), (None, "Nada", D), (6, None, D)],
        "nu_cidade int, cidade string, dt string",
    )


def test_city_pairs_resolve_by_role_date_and_folded_name(spark, cities):
    requests = spark.createDataFrame(
        [(1, "sao jose", "LAVRAS", D), (2, "lavras", "SÃO JOSÉ", D), (3, "Lavras", "Lavras", D),
         (4, "STRASSE", "Lavras", D), (5, "sao jose", "Lavras", "2024-06-02"), (6, "Itu", "Lavras", D),
         (7, "bom jesus", "Lavras", D), (8, "Nada", "Lavras", D)],
        "n int, origin string, destination string, dt string",
    )
    out = {r["n"]: (r["status"], r["route_uuid"], r["cidade_origin"]) for r in resolve_city_pairs(requests, cities).collect()}
    assert out == {
        1: ("resolved", "1_2", "São José"), 2: ("resolved", "2_1", "Lavras"), 3: ("resolved", "2_2", "Lavras"),
        4: ("resolved", "3_2", "Straße"), 5: ("missing", None, None), 6: ("missing", None, None),
        7: ("ambiguous", None, None), 8: ("missing", None, None),
    }


def test_homonyms_are_flagged_not_picked(cities):
    rows = {(r["folded"], r["dt"]): (r["nu_cidade"], r["homonyms"]) for r in city_names(cities).collect()}
    assert rows[("bom jesus", D)] == (None, True) and rows[("lavras", D)] == (2, False)


def test_missing_references_of_both_roles(spark):
    facts = spark.createDataFrame([(1, 2, D), (1, 3, D), (3, 3, D), (2, 1, "x")], "o int, d int, dt string")
    known = spark.createDataFrame([(1, D), (2, D), (9, D)], "c int, dt string")
    out = missing_references(facts, known, "c", "dt", ROLES)
    assert {tuple(r) for r in out.collect()} == {(3, D), (2, "x"), (1, "x")}
    named = facts.withColumns({"on": F.concat(F.lit("n"), "o"), "dn": F.concat(F.lit("n"), "d")})
    out = missing_references(named, known, "c", "dt", ROLES, {"a": "on", "b": "dn"})
    assert {r["name"] for r in out.collect()} == {"n3", "n2", "n1"}


def test_broadcast_only_what_was_seen_to_be_small(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("x" * 100).alias("s"), F.array("id").alias("a"))
    known = sized(df, "known")
    assert known.rows == 1000 and known.df.count() == 1000
    assert 148_000 <= known.bytes <= 200_000  # 48 for the columns, the text, the array as text
    assert broadcast_within(known, 200_000) is not known.df
    assert broadcast_within(known, 50_000) is known.df
    assert broadcast_within(df) is df  # of unknown size: left to Spark
    assert sized(df.limit(0), "none").bytes == 0


def test_no_job_runs_while_plans_are_built(spark, cities):
    known = sized(cities, "cities")
    requests = spark.createDataFrame([("Lavras", "Lavras", D)], "origin string, destination string, dt string")
    facts = spark.createDataFrame([(1, 2, D)], "o int, d int, dt string")
    group = "plan-building"
    spark.sparkContext.setJobGroup(group, "plans")
    try:
        for reference in (cities, known):
            resolve_city_pairs(requests, reference)
            attach_twice(facts, broadcast_within(reference), "nu_cidade", "dt", ROLES, ["cidade"])
        merge_changed(facts, facts, ["o"], "d", changed=sized_of(facts))
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def sized_of(df):
    return Sized(df, 1, 1)


def wide(spark, rows, parts=8):
    """A third of all rows share one key."""
    return spark.range(0, rows, 1, parts).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).cast("int").alias("o"),
        F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 89).cast("int").alias("d"),
        F.lit(D).alias("dt"),
        F.repeat(F.col("id").cast("string"), F.lit(5)).alias("pad"),
    )


def test_small_reference_moves_no_fact_row(spark):
    known = spark.range(97).select(F.col("id").cast("int").alias("c"), F.lit(D).alias("dt"), (F.col("id") * 2).alias("t"))
    out = attach_twice(wide(spark, 3000), broadcast_within(sized(known, "known")), "c", "dt", ROLES, ["t"])
    text = plan_of(out)
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text
    assert out.count() == 3000
    assert out.where((F.col("t_a") != F.col("o") * 2) | (F.col("t_b") != F.col("d") * 2)).count() == 0


def test_hot_key_of_a_large_reference_is_split(spark):
    """Beyond the broadcast bound adaptive execution splits the partitions of a hot city."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        known = spark.range(97).select(F.col("id").cast("int").alias("c"), F.lit(D).alias("dt"), (F.col("id") * 2).alias("t"))
        out = attach_twice(wide(spark, 120_000), broadcast_within(sized(known, "known"), 10), "c", "dt", ROLES, ["t"])
        rows = out.groupBy().agg(F.count("*").alias("n"), F.sum("t_a").alias("a"), F.sum("t_b").alias("b"), F.sum(F.length("pad")).alias("p"))
        got = rows.collect()[0]
        assert "SortMergeJoin(skew=true)" in plan_of(rows)
        want = wide(spark, 120_000).agg(F.sum(F.col("o") * 2), F.sum(F.col("d") * 2)).first()
        assert (got["n"], got["a"], got["b"]) == (120_000, want[0], want[1])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
