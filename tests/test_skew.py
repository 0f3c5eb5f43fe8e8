"""Queries on skewed tables with the plans of large ones: sort-merge joins,
split partitions, no broadcast. ``check_skew`` does the same for all queries."""

import pytest

import __spark_entry__ as driver
from tests.check_skew import build, difference
from tests.oracle import connect

LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    build(folder, 2, "/root/testdata/sf0.01")
    return folder, connect(folder)


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k) for k in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    ["fact_sales", "sales_summary", "customer_sales_summary", "scd1_upsert", "scd2_merge",
     "dq_duplicates", "fx_dim"],
)
def test_frequent_keys(large, skewed, tmp_path, name):
    folder, duck = skewed
    out = str(tmp_path / name)
    driver.queries()[name](large, folder).write.parquet(out)
    n, extra, lost = difference(duck, out, driver.oracle_sql()[name])
    assert n > 0 and (extra, lost) == (0, 0)


def test_skewed_join_is_split(large, skewed):
    """One order holds a third of all rows; its partition is read in parts."""
    folder, _ = skewed
    df = driver.queries()["dq_ship_after_order"](large, folder)
    df.collect()
    assert "skewed" in df._jdf.queryExecution().executedPlan().toString()
