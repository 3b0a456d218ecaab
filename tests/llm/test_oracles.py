"""The operators that SQL can express, against DuckDB."""

import os

import oracle
import pytest

from tidemark.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.ORACLES[name]) == []
