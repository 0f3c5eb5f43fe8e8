"""Queries of the subpackage against their SQL."""

import pytest

from layerloom.llm import queries  # noqa: F401
from layerloom.llm.registry import ORACLES, QUERIES
from tests.oracle import connect, spark_result, sql_result


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    columns, rows = spark_result(QUERIES[name](spark, sf_dir))
    sql_columns, sql_rows = sql_result(connect(sf_dir), ORACLES[name])
    assert columns == sql_columns
    assert rows == sql_rows
    assert sum(rows.values()) > 0
