"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as driver
from layerloom.queries.registry import ORACLES, QUERIES
from tests.oracle import connect, spark_result, sql_result


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df, sql = QUERIES[name](spark, sf_dir), ORACLES[name]
    relation = duck.sql(sql)
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == dict(
        zip(relation.columns, map(str, relation.types))
    )
    columns, rows = spark_result(df)
    sql_columns, sql_rows = sql_result(duck, sql)
    assert columns == sql_columns
    assert rows == sql_rows
    assert sum(rows.values()) > 0


def test_all_queries_are_registered():
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
