"""The queries that SQL can express, row for row in another engine."""

import check_oracle
import pytest

from badgeflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, sf_dir, name):
    con = check_oracle.duck(sf_dir)
    assert check_oracle.compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name]) is None
