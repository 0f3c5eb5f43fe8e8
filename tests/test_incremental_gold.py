"""Sales tables that are brought up to date equal those built anew, and leave other months alone."""

import os
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.plans import gold
from layerloom.plans.lake import GOLD, Lake
from layerloom.queries.gold import _silver

ORDERS = "OrderID int, CustomerID int, ProductID int, Quantity int, UnitPrice decimal(18,2), Discount decimal(5,2), TotalAmount decimal(18,2), OrderDate timestamp"
CUSTOMERS = "CustomerID int, CustomerName string, City string, State string, Country string, LastUpdated timestamp, _RecordHash string"


def _run(n):
    at = datetime(2024, 7, 1) + timedelta(days=n)
    return RunContext("R", f"b{n}", at, at.date())


def _order(i, customer, product, day, amount):
    return (i, customer, product, 1, Decimal("2.00"), Decimal("0.10"), Decimal(str(amount)), datetime.combine(day, datetime.min.time()))


def _customer(i, name, n):
    return (i, name, "c", "s", "x", datetime(2024, 1, 1) + timedelta(days=n), f"{name}{i}")


LOADS = [
    (
        [_order(i, i % 5, i % 3, date(2024, 1 + i % 6, 3), f"{i}.25") for i in range(60)],
        [_customer(i, "old", 0) for i in range(4)],
        [(i, f"p{i}") for i in (1, 2)],
    ),
    # A later order, one that moves to another month, the only one of its month that moves away, and a new customer.
    (
        [_order(100, 1, 1, date(2024, 7, 1), "7.5"), _order(3, 1, 1, date(2024, 6, 9), "8.00"), _order(200, 2, 2, date(2024, 8, 1), "1")],
        [_customer(4, "late", 1)],
        [(i, f"p{i}") for i in (1, 2)],
    ),
    ([_order(200, 2, 2, date(2024, 9, 1), "2")], [_customer(2, "renamed", 2)], [(i, f"p{i}") for i in (1, 2)]),
    # Nothing but a product that takes the first place: every product after it has another key.
    ([], [], [(i, f"p{i}") for i in (0, 1, 2)]),
    # An older version of an order comes in late and does not win.
    ([_order(100, 1, 1, date(2024, 2, 1), "99")], [], [(i, f"p{i}") for i in (0, 1, 2)]),
]


def _load(spark, lake, n, orders, customers, products):
    run = _run(n)
    _silver(lake, "customers", spark.createDataFrame(customers, CUSTOMERS), run)
    _silver(lake, "products", spark.createDataFrame(products, "ProductID int, ProductName string"), run)
    _silver(lake, "orders", spark.createDataFrame(orders, ORDERS), run)
    gold.load_versions(lake, lake.metadata.table("customers"), "customer_dim", run, "CustomerID")
    gold.load_dimension(lake, lake.metadata.table("products"), "product_dim", run)


def _sales(lake, n):
    gold.load_fact(lake, lake.metadata.table("orders"), _run(n))
    gold.load_summaries(lake, _run(n))


def _tables(lake):
    found = {}
    for name in (gold.FACT_TABLE, gold.SALES_SUMMARY, gold.CUSTOMER_SALES_SUMMARY):
        rows = gold.gold_table(lake, name)
        found[name] = sorted((tuple(r[c] for c in sorted(rows.columns)) for r in rows.collect()), key=str)
    return found


def _rebuilt(lake):
    """The same lake, its sales tables built by the last run alone."""
    orders = gold.valid_rows(lake, lake.metadata.table("orders"), _run(0))
    names = _run(0).columns
    customers = gold.current_versions(lake, "customer_dim")
    fact = gold.sales.fact_sales(
        orders, customers, lake.read(GOLD, "product_dim"), audit=[names.batch_id, names.run_id, names.processed_at]
    )
    frames = {
        gold.FACT_TABLE: fact,
        gold.SALES_SUMMARY: gold.sales.sales_summary(fact, ordered=False),
        gold.CUSTOMER_SALES_SUMMARY: gold.sales.customer_sales_summary(fact, customers, ordered=False),
    }
    return {k: sorted((tuple(r[c] for c in sorted(v.columns)) for r in v.collect()), key=str) for k, v in frames.items()}


def _files(path):
    return {
        folder.rsplit("=", 1)[1]: {(f, os.stat(f"{folder}/{f}").st_mtime_ns) for f in files if f.endswith(".parquet")}
        for folder, _, files in os.walk(path)
        if "_Period=" in folder.rsplit("/", 1)[1]
    }


def test_updates_equal_rebuilds_and_touch_their_months_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    folder = f"{tmp_path}/gold/fact_sales/_Partitions"
    before = {}
    for n, rows in enumerate(LOADS):
        _load(spark, lake, n, *rows)
        _sales(lake, n)
        assert _tables(lake) == _rebuilt(lake), n
        after = _files(folder)
        changed = {k for k in after if after[k] != before.get(k)}
        if n == 1:
            # Order 3 was in April; customer 4 had orders before it was known: in months 5, 4, ...
            assert changed >= {"2024-07-01", "2024-06-01", "2024-04-01", "2024-08-01"}
        if n == 2:
            months = {f"{d:%Y-%m}-01" for c, d in ((r.CustomerID, r.OrderDate) for r in lake.read(GOLD, gold.FACT_TABLE).collect()) if c == 2}
            assert changed == months | {"2024-08-01"} and "2024-07-01" not in changed
        if n == 4:
            assert changed == {"2024-02-01", "2024-07-01"}
        before = after
    assert lake.read(GOLD, gold.FACT_TABLE).where("_Period = date'2024-08-01'").count() == 0


def test_a_failed_run_leaves_its_months_to_the_next(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    _load(spark, lake, 0, *LOADS[0])
    _sales(lake, 0)
    _load(spark, lake, 1, *LOADS[1])
    with monkeypatch.context() as patch:
        patch.setattr(gold.sales, "customer_days", lambda fact: fact.select(F.raise_error(F.lit("lost")).alias("_Period")))
        with pytest.raises(Exception):
            _sales(lake, 1)
    _load(spark, lake, 2, *LOADS[2])
    _sales(lake, 2)
    assert _tables(lake) == _rebuilt(lake)


def test_full_tables_are_built_anew(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    config = replace(lake.metadata.table("orders"), load_type="FULL")
    for n, rows in enumerate(LOADS[:2]):
        _load(spark, lake, n, *rows)
        gold.load_fact(lake, config, _run(n))
        gold.load_summaries(lake, _run(n))
    assert {r.OrderID for r in lake.read(GOLD, gold.FACT_TABLE).collect()} == {100, 3, 200}
    assert lake.read(GOLD, gold.SALES_SUMMARY).count() == 3
