"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import differences, duck

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from orderlake.plans.oracles import ORACLES
from orderlake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck(SMOKE_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, connection, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    assert differences(df, ORACLES[name], connection) is None


def test_entry(spark):
    assert entry(spark).count() > 0
