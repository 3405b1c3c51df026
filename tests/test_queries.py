"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from meterlake import catalogue
from tests.compare import difference

QUERIES, SQL = catalogue.QUERIES, catalogue.SQL


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def test_entry_lists_the_catalogue():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None
