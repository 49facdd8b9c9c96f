from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.compare import difference, sql_engine


@pytest.fixture(scope="module")
def con(sf_dir):
    return sql_engine(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, QUERIES[name], ORACLE[name], sf_dir) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1387
