from __future__ import annotations

import random

from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.operators.changes import changed_keys
from tierflow.operators.filters import (
    among, missing_fields, nothing_in, with_required, without_required,
)
from tierflow.operators.latest import latest_per_key, merge_changed, merge_latest, union_aligned
from tierflow.operators.metrics import observed, row_metrics
from tierflow.operators.sizing import sized

ROWS = "k string, v int, t int, p string"


def test_highest_version_wins_and_null_keys_go(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, "old"), ("a", 2, 0, "new"), ("b", None, 0, "none"), ("b", 1, 0, "some"), (None, 9, 0, "x")],
        ROWS,
    )
    out = latest_per_key(df, ["k"], "v").collect()
    assert {(r["k"], r["p"]) for r in out} == {("a", "new"), ("b", "some")}


def test_incoming_wins_ties_then_tie_columns_decide(spark):
    stored = spark.createDataFrame([("a", 1, "stored"), ("c", 5, "stored")], "k string, v int, p string")
    incoming = spark.createDataFrame(
        [("a", 1, 1, "second"), ("a", 1, 0, "first"), ("c", 4, 0, "older")], "k string, v int, t int, p string"
    )
    out = merge_latest(stored, incoming, ["k"], "v", [F.asc("t")])
    assert out.columns == stored.columns
    assert {(r["k"], r["p"]) for r in out.collect()} == {("a", "first"), ("c", "stored")}


def test_one_row_per_key_leaves_each_map_task(spark):
    """A key with most of the rows is reduced before the shuffle."""
    df = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("v"),
    )
    out = latest_per_key(df, ["k"], "v")
    text = plan_of(out)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "Final" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    best = {}
    for i in range(20_000):
        key = 0 if i % 3 == 0 else i % 50
        best[key] = max(best.get(key, -1), i)
    assert {(r["k"], r["v"]) for r in out.collect()} == set(best.items())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 2)), max_size=8),
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=8),
    st.randoms(use_true_random=False),
)
def test_merge_matches_brute_force_in_any_order(spark, stored, incoming, rnd: random.Random):
    best: dict = {}
    for arrival, rows in ((0, incoming), (1, stored)):
        for k, v, t in rows:
            rank = (-v, arrival, t)
            if k not in best or rank < best[k]:
                best[k] = rank
    want = {(k, -r[0], r[1], r[2]) for k, r in best.items()}
    rnd.shuffle(incoming)
    schema = "k string, v int, t int, side int"
    left = spark.createDataFrame([(*r, 1) for r in stored], schema)
    right = spark.createDataFrame([(*r, 0) for r in incoming], schema)
    out = merge_latest(left, right, ["k"], "v", [F.asc("t")]).collect()
    assert {(r["k"], r["v"], r["side"], r["t"]) for r in out} == want and len(out) == len(want)


def test_required_split_is_complete(spark):
    df = spark.createDataFrame([(1, "x", None), (None, "y", 2), (3, None, None), (4, "z", 5)], "a int, b string, c int")
    good = with_required(df, ["a", "b"]).collect()
    bad = without_required(df, ["a", "b"]).collect()
    assert {r["a"] for r in good} == {1, 4}
    assert {r["reason"] for r in bad} == {"missing:a", "missing:b"}
    assert '{"b":"y","c":2}' in {r["payload"] for r in bad}
    assert len(good) + len(bad) == df.count()


def test_missing_fields_lists_all(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(missing_fields(["a", "b"])).collect()] == ["a,b", "b", None]


def test_required_filter_reaches_the_scan(spark, base_dir):
    spark.createDataFrame([(1, "x"), (None, "y")], "a int, b string").write.parquet(f"{base_dir}/t")
    text = with_required(spark.read.parquet(f"{base_dir}/t"), ["a", "b"])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(a), IsNotNull(b)]" in text


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert {tuple(r) for r in union_aligned(a, b).collect()} == {(1, "x"), (2, "y")}


def test_observed_figures(spark, base_dir):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    counted, figures = observed(df, row_metrics(["a", "b"]))
    counted.write.parquet(f"{base_dir}/t")
    assert figures.get == {"rows": 3, "null_a": 1, "null_b": 2}


def test_merge_of_few_keys_leaves_other_stored_rows_unshuffled(spark, base_dir):
    spark.range(2000).selectExpr("cast(id as string) k", "1 v", "0 side").write.parquet(f"{base_dir}/t")
    stored = spark.read.parquet(f"{base_dir}/t")
    incoming = spark.createDataFrame(
        [("5", 2, 1), ("5", 3, 2), ("6", 0, 1), ("7", 1, 1), ("new", 0, 1), (None, 9, 1)], "k string, v int, side int"
    )
    out = merge_changed(stored, incoming, ["k"], "v", changed=sized(incoming.select("k"), "keys"))
    text = plan_of(out)
    others = text[: text.index("Window")]  # the branch of the other rows comes first
    assert "BroadcastHashJoin" in others and "LeftAnti" in others and "Exchange hashpartitioning" not in others.split("BroadcastExchange")[0]
    rows = {r["k"]: (r["v"], r["side"]) for r in out.collect()}
    assert len(rows) == out.count() == 2001
    assert (rows["5"], rows["6"], rows["7"], rows["new"], rows["8"]) == ((3, 2), (1, 0), (1, 1), (0, 1), (1, 0))


def test_merge_is_the_same_on_both_sides_of_the_bound(spark):
    """Also if a stored key is there twice: untouched ones stay, touched ones are merged."""
    stored = spark.createDataFrame(
        [("twice", 1, 0), ("twice", 1, 0), ("hit", 1, 0), ("hit", 2, 0), ("one", 1, 0), (None, 1, 0)],
        "k string, v int, side int",
    )
    incoming = spark.createDataFrame([("hit", 2, 1), ("new", 1, 1), (None, 5, 1)], "k string, v int, side int")
    changed = sized(incoming.select("k"), "keys")
    found = [
        sorted(map(tuple, merge_changed(stored, incoming, ["k"], "v", changed=given, max_bytes=most).collect()))
        for given, most in ((changed, 1 << 20), (changed, 1), (None, 1))
    ]
    assert found[0] == found[1] == found[2] == [
        ("hit", 2, 1), ("new", 1, 1), ("one", 1, 0), ("twice", 1, 0), ("twice", 1, 0),
    ]


def test_changed_keys_between_two_states(spark):
    schema = "k string, v int, p string, steps array<map<string,string>>"
    before = spark.createDataFrame(
        [("same", 1, "a", [{"x": "1"}]), ("newer", 1, "a", None), ("gone", 1, "a", None), ("text", 1, "a", None),
         ("nested", 1, "a", [{"x": "1"}]), ("null", 1, None, None)], schema,
    )
    after = spark.createDataFrame(
        [("same", 1, "a", [{"x": "1"}]), ("newer", 2, "a", None), ("text", 1, "b", None),
         ("nested", 1, "a", [{"x": "2"}]), ("null", 1, None, None), ("born", 1, "a", None)], schema,
    )
    assert {tuple(r) for r in changed_keys(before, after, "k", "v").collect()} == {
        ("newer", "updated"), ("gone", "removed"), ("text", "updated"), ("nested", "updated"), ("born", "added"),
    }
    assert changed_keys(after, after, "k", "v").count() == 0


def test_membership_by_literals_lists_and_tables(spark, base_dir):
    spark.range(300).selectExpr("id", "concat('d', id % 100) as dt").write.partitionBy("dt").parquet(f"{base_dir}/t")
    df = spark.read.schema("id long, dt string").parquet(f"{base_dir}/t")
    few, many = ["d1", "d2"], [f"d{i}" for i in range(70)]
    few_table = sized(spark.createDataFrame([(d,) for d in [*few, None]], "dt string"), "few")
    short, long = among(df, "dt", few), among(df, "dt", many)
    by_table, by_frame = among(df, "dt", few_table), among(df, "dt", few_table.df)
    assert short.count() == by_table.count() == by_frame.count() == 6 and long.count() == 210
    assert among(df, "dt", None) is df and among(df, "dt", []).count() == 0
    assert df.columns == by_table.columns == long.columns
    for pruned in (long, by_table):
        assert "dynamicpruning" in plan_of(pruned).lower() and "LeftSemi" in plan_of(pruned)
    assert "PartitionFilters: [dt" in short._jdf.queryExecution().toString()
    assert [nothing_in(v) for v in ([], few, None, few_table, sized(few_table.df.limit(0), "no"))] == [
        True, False, False, False, True,
    ]
