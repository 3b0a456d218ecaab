"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import oracle
import pytest

from tidemark import demos

SF = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("query", sorted(demos.QUERIES))
def test_query_agrees_with_sql(spark, duck, query):
    df = demos.QUERIES[query](spark, SF)
    assert oracle.differences(df, duck, demos.ORACLES[query]) == []


def test_every_query_has_sql():
    assert set(demos.QUERIES) == set(demos.ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(demos.QUERIES) <= set(entry.queries())
    assert set(demos.ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
