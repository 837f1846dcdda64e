"""Every registered query next to its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from check_queries import compare
from tierflow.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    good, note = compare(spark, SF_DIR, entry_point.queries()[name], entry_point.oracle_sql()[name])
    assert good, note


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry_point.entry(spark), entry_point.entry(spark)
    assert first.schema == second.schema and first.count() > 0
