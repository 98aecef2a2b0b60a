"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from registry import queries as registered

SQL = entry.oracle_sql()
QUERIES = {k: q for k, q in entry.queries().items() if k in SQL}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(registered.keys()) <= SQL.keys() == QUERIES.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, key):
    assert difference(QUERIES[key](spark, sf_dir), duck, SQL[key]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
