from __future__ import annotations

import pytest

from callgrain.llm.queries import oracle_sql, queries
from verification.compare import difference, oracle


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert difference(queries()[name](spark, sf).toPandas(), oracle(sf).execute(oracle_sql()[name]).df()) is None
