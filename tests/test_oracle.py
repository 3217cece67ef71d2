"""Every query against its SQL in another engine, row for row."""

import check_oracle
import pytest

import __spark_entry__ as entry
from badgeflow.plans import oracles, registry

QUERIES = registry.QUERIES
ORACLE = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, sf_dir, name):
    assert check_oracle.compare(spark, con, sf_dir, name, QUERIES[name], ORACLE[name]) is None


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 5
