"""Registered queries with SQL twins, on the smallest tables."""

import pytest

from equigauge.llm import queries
from tests.compare import compare, open_duckdb

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), open_duckdb(SF), queries.ORACLES[name]) == []
