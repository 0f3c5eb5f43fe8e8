"""Physical plans: what must not appear in them, whatever the data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from layerloom.operators import sales, validate
from layerloom.operators.incremental import load_slice
from layerloom.operators.keys import dense_key, keep_latest
from layerloom.queries.registry import QUERIES, table

PYTHON_NODES = ("PythonEval", "MapInPandas", "FlatMapGroups", "ArrowEval", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not any(node in plan for node in PYTHON_NODES)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Window" not in plan


def test_numbering_has_no_single_task(spark, sf_dir):
    plan = plan_of(dense_key(table(spark, sf_dir, "part"), ["p_partkey"], "sk"))
    assert "SinglePartition" not in plan and "Exchange" not in plan


def test_latest_row_is_reduced_before_the_shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    plan = plan_of(keep_latest(events, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["dq_positive"](spark, sf_dir))
    assert "LessThanOrEqual(c_acctbal,0.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    plan = plan_of(QUERIES["incremental_slice"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan


def test_mark_of_an_incremental_source_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "customers")
    spark.range(3).withColumn("LastUpdated", F.current_timestamp()).write.parquet(path)
    source = spark.read.parquet(path).withColumn("m", F.col("LastUpdated").try_cast("timestamp"))
    mark = F.lit("2024-01-01 00:00:00").cast("timestamp")
    wanted = load_slice(source, "INCREMENTAL", "m", mark, inclusive=True, undated=True)
    assert "PushedFilters: [Or(GreaterThanOrEqual(LastUpdated," in plan_of(wanted)


def test_summary_adds_up_before_it_joins(spark, sf_dir):
    plan = plan_of(QUERIES["sales_summary"](spark, sf_dir))
    assert "partial_sum" in plan.split("Join")[-1]


def _sums_follow_the_shuffle(plan: str, partial: str) -> bool:
    return plan.count("Exchange") == 1 and plan.index(partial) < plan.index("Exchange")


def test_copies_are_counted_after_the_shuffle(spark, monkeypatch):
    """Nearly unique keys would fill the memory of the tasks that read them."""
    found = []
    monkeypatch.setattr(validate, "staged", lambda df, label: found.append(df) or df)
    rows = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "b")], "k int, v string")
    counted = validate.with_copies(rows, ["k", "v"])
    assert _sums_follow_the_shuffle(plan_of(found[0]), "partial_count")
    assert [r["_Copies"] for r in counted.collect()] == [1] * 4


def test_latest_of_few_rows_is_sought_after_the_shuffle(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 1, "d"), (2, None, "e")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    latest = keep_latest(df, ["k"], ["t"], few=True)
    assert _sums_follow_the_shuffle(plan_of(latest), "partial_max_by")
    assert sorted(r["v"] for r in latest.collect()) == ["b", "c", "d", "e"]


def test_customer_days_are_added_up_in_one_shuffle(spark):
    rows = [(1, "2024-01-01 08:00:00", 1, 7, 2, "1.50"), (1, "2024-01-01 08:00:00", 1, 7, 3, "2.00"), (2, None, 1, 7, 4, None)]
    fact = spark.createDataFrame(rows, "OrderID int, at string, CustomerSK int, CustomerID int, Quantity int, amount string")
    fact = fact.withColumns({"OrderDate": F.col("at").cast("timestamp"), "TotalAmount": F.col("amount").cast("decimal(18,2)")})
    days = sales.customer_days(sales.with_period(fact))
    assert _sums_follow_the_shuffle(plan_of(days), "partial_sum")
    found = {tuple(r) for r in days.select("TotalOrders", "TotalQuantity", F.col("Amount").cast("string"), "Amounts").collect()}
    assert found == {(1, 5, "3.50", 2), (1, 4, None, 0)}
