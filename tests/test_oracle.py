"""Every registered query against its SQL; queries without SQL must at least produce rows."""

import pytest
from oracle import compare

from fieldhouse.workload import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, name):
    assert compare(spark, QUERIES[name], ORACLES[name], data) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_produces_rows(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
