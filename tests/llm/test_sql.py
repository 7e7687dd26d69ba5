"""The queries that have SQL against it, over whole tables."""

import pytest

from oracle import connected, oracle_rows, spark_rows
from tidegauge.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, FOLDER))
    assert rows
    assert (columns, rows) == oracle_rows(connected(FOLDER), queries.ORACLES[name])
