from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tierflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 64, 7), (97, 129, 203), (128, 64, 1001), (70, 33, 34)])
def test_product_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(1 << 28), 1 << 28, (m, k)), rng.integers(-(1 << 28), 1 << 28, (k, n))
    want = a.astype(object) @ b.astype(object)
    assert (negatives.product(a, b) == want).all()


def test_best_keeps_ties_by_id():
    scores = np.array([[5, 7, 7, 7, negatives.ABSENT], [negatives.ABSENT] * 5])
    row, col = negatives.best(scores, np.array([1, 9, 3, 4, 2]), 2)
    assert list(row) == [0, 0] and list(col) == [2, 3]


def brute(rows):
    """Plain Python over distinct valid rows."""
    held = set()
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        held.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for a_id, a_label, a in held:
        if a_id % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), i, l) for i, l, v in held if i != a_id]
        same = sorted(((-s, i) for s, i, l in scored if l == a_label))[:5]
        for minus, p in same:
            ok = [(-s, i) for s, i, l in scored if l != a_label and -80 * minus <= 100 * s <= -100 * minus]
            out += [(a_id, p, k + 1, i, -minus, -s) for k, (s, i) in enumerate(sorted(ok)[:5])]
    return sorted(out)


def got(spark, rows, schema=SCHEMA, **sizes):
    df = negatives.mined(spark.createDataFrame(rows, schema), **sizes)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert dict(df.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"cell": 40, "block": 2}])
def test_equals_brute_force(spark, sizes):
    random.seed(5)
    pool = [[round(random.uniform(-0.3, 0.7), 1) for _ in range(6)] for _ in range(60)]
    rows = [(i * 20, random.choice(pool), random.choice([1, 1, 1, 2, 9])) for i in range(250)]
    assert got(spark, rows, **sizes) == brute(rows) != []


def test_odd_rows(spark):
    one = [1.0, 0.5]
    rows = [
        (0, one, 2), (0, one, 2), (0, [0.5, 1.0], 2), (1, one, 3), (1, one, 3), (2, one, 3), (3, [1.0], 4),
        (4, [], 4), (5, None, 3), (None, one, 3), (6, one, None), (8, [None, 1.0], 3),
        (9, [float("nan"), 1.0], 3), (10, [float("inf"), 1.0], 3), (11, [1.0, 0.5, 3.0], 4), (100, one, 4), (200, one, 77),
    ]
    assert got(spark, rows) == brute(rows) != []
    wide = [(*r, 1, 2, 3) for r in rows]
    named = SCHEMA + ", anchor int, pair int, score int"
    assert got(spark, wide, named) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, [(100, one, 1)]) == []
