"""Every registered query against independent SQL, on the smallest given tables."""

import os

import pytest

from verification.catalog import oracle_sql, queries
from verification.compare import difference, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = oracle(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(ours, duck.execute(SQL[name]).df()) is None


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
