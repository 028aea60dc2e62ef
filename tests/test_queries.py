"""Every registered query against its expected SQL, on the smallest generated tables."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SMALL
from verify.compare import connect, difference
from verify.registry import expected_sql, spark_queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="generated tables are not available")

QUERIES = spark_queries()
SQL = expected_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None
