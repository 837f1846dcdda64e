from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tierflow.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, results=10):
    """(item_id, rank, doc_id, score) by plain Python."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for d, c in counts:
            if d is None or not c:
                continue
            m = 25 + 75 * sum(c.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms_of(text) if c[t]
            )
            if score > 0:
                scored.append((-score, d))
        out += [(item_id, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scored)[:results])]
    return sorted(out, key=str)


def got(spark, docs, items, doc_schema="doc_id long, text string", item_schema="item_id long, text string", **options):
    df = search.searched(spark.createDataFrame(docs, doc_schema), spark.createDataFrame(items, item_schema), **options)
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(n):
    random.seed(3)
    pool = [f"w{i}" for i in range(60)] + ["É", "ß1", "Ünï"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    text = lambda k: " ".join(random.choices(pool, weights, k=k))
    docs = [(1000 - i, text(random.randint(1, 40))) for i in range(n)]
    docs += [(2000 + i, docs[5][1]) for i in range(15)]
    return docs, [(i, text(8) + " " + docs[i][1][:30]) for i in range(12)]


@pytest.mark.parametrize("options", [{}, {"shard": 16, "together": 5, "owners": 4, "results": 3}, {"owners": 1}])
def test_equals_brute_force(spark, options):
    docs, items = corpus(150)
    assert got(spark, docs, items, **options) == brute(docs, items, options.get("results", 10)) != []


def test_terms():
    for text in ("Ab-c_d 9z", "École naïve​x", "A" * 3 + "\x00b", "😀 x\x7fy", ""):
        assert [t.decode() for t in search.terms(text)] == terms_of(text)
    assert search.terms(None) == []


def test_losers_leave_and_no_winner_does():
    scores = np.array([9, 1, 7, 4, 7])
    assert list(search._survivors(scores, 0, 2)) == [0, 2, 4]
    assert list(search._survivors(scores, 3, 2)) == [0, 2, 3, 4]
    assert list(search._survivors(scores, 0, 9)) == [0, 1, 2, 3, 4]


def test_odd_rows(spark):
    docs = [
        (None, "alpha beta"), (1, None), (2, ""), (3, "alpha"), (3, "alpha"), (4, "--- !"), (5, "beta " * 20_000),
        (6, "Alpha gamma"), (7, "delta"),
    ]
    items = [(1, "alpha beta beta"), (1, "alpha beta beta"), (2, None), (3, ""), (4, "nowhere"), (None, "gamma")]
    assert got(spark, docs, items) == brute(docs, items) != []
    wide = got(
        spark, [(*d, 1, "r", 2) for d in docs], [(*i, 3, "t") for i in items],
        "doc_id long, text string, row int, term string, n int", "item_id long, text string, row int, term string",
    )
    assert wide == brute(docs, items)
    assert got(spark, [], items) == [] == got(spark, docs, [])
