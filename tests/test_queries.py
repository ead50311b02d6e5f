"""Every registered query against its SQL on DuckDB."""

import pytest
from check_queries import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    verdict = compare(spark, duck, name, queries()[name], oracle_sql()[name], sf_dir)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry(spark).count() == 161


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())
