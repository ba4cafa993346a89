"""Every registered query against its DuckDB text on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, key):
    ok, note = compare(spark, con, sf_dir, key, queries()[key], oracle_sql().get(key))
    assert ok or note.endswith("EMPTY"), note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
