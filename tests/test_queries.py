"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, open_duckdb

SF = "/root/testdata/sf0.001"
TWINS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, TWINS[name]) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    flagged = [r["group"] for r in rows if r["flag"]]
    assert len(rows) == 8
    assert flagged == ["race: Group D"]
