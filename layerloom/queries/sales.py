"""Fact and summary queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import sales
from layerloom.operators.keys import dense_key
from layerloom.operators.scd import current_rows, initial_versions
from layerloom.queries import inputs
from layerloom.queries.dimensions import CUSTOMER_HISTORY_SQL, customer_history
from layerloom.queries.registry import query, run_at

RUN = run_at(inputs.SECOND_LOAD, "batch-2")

CUSTOMERS_SQL = f"""
    select *, row_number() over (order by CustomerID) as CustomerSK
    from ({inputs.customers_sql(None)})"""
PRODUCTS_SQL = """
    select p_partkey as ProductID, row_number() over (order by p_partkey) as ProductSK from part"""

# The sum is rounded once. The mean is rounded half up from the exact quotient of
# ten-thousandths, which doubles could miss; amounts are never negative here.
MEASURES_SQL = """
           cast(count(distinct OrderID) as bigint) as TotalOrders,
           cast(sum(Quantity) as bigint) as TotalQuantity,
           cast(round(sum(TotalAmount), 2) as double) as TotalSales,
           cast((2 * cast(sum(TotalAmount) * 10000 as hugeint) + 100 * count(TotalAmount))
                // (200 * count(TotalAmount)) as double) / 100 as AverageOrderValue"""
LINES_SQL = """
    select l_orderkey as OrderID, o_custkey as CustomerID, l_partkey as ProductID,
           o_orderdate as OrderDate, cast(l_quantity as integer) as Quantity,
           cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(5,2)))
                as decimal(18,4)) as TotalAmount
    from lineitem join orders on l_orderkey = o_orderkey"""


def customers(spark: SparkSession, sf: str) -> DataFrame:
    loaded = initial_versions(inputs.customers_as_of(spark, sf, None), "CustomerID", RUN)
    return current_rows(loaded, RUN)


def _plain(summary: DataFrame, *ids: str) -> DataFrame:
    typed = {
        "TotalOrders": "bigint",
        "TotalQuantity": "bigint",
        "TotalSales": "double",
        "AverageOrderValue": "double",
    } | {i: "bigint" for i in ids}
    return summary.withColumns({c: F.col(c).cast(t) for c, t in typed.items()})


def _fact(spark: SparkSession, sf: str, headers: DataFrame) -> DataFrame:
    """Order rows from headers that carry the customer key; key and price of
    the product come from one lookup."""
    dim = dense_key(inputs.products(spark, sf), ["ProductID"], "ProductSK")
    priced = dim.select("ProductID", "ProductSK", F.col("SellingPrice").alias("UnitPrice"))
    items = inputs.order_items(spark, sf, amount="double")
    rows = items.join(headers, "OrderID").join(priced, "ProductID")
    fact = sales.fact_sales(rows)
    typed = {
        "CustomerSK": "bigint",
        "ProductSK": "bigint",
        "OrderDate": "date",
        "UnitPrice": "double",
        "Discount": "double",
        "TotalAmount": "double",
    }
    return fact.withColumns({c: F.col(c).cast(t) for c, t in typed.items()})


FACT_COLUMNS_SQL = """
           o.OrderID, cast(o.OrderDate as date) as OrderDate, CustomerSK, ProductSK, o.CustomerID,
           o.ProductID, o.Quantity, cast(o.UnitPrice as double) as UnitPrice,
           cast(o.Discount as double) as Discount, cast(o.TotalAmount as double) as TotalAmount"""


@query(
    "fact_sales",
    f"""
    with o as ({inputs.ORDER_ROWS_SQL}), c as ({CUSTOMERS_SQL}), p as ({PRODUCTS_SQL})
    select {FACT_COLUMNS_SQL}
    from o left join c on o.CustomerID = c.CustomerID left join p on o.ProductID = p.ProductID""",
)
def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows with customer and product keys. The customer is looked up on
    the order headers, which are fewer than the rows."""
    headers = sales.with_customer_key(inputs.order_headers(spark, sf), customers(spark, sf))
    return _fact(spark, sf, headers)


@query(
    "fact_sales_as_of",
    f"""
    with o as ({inputs.ORDER_ROWS_SQL}), c as ({CUSTOMER_HISTORY_SQL}), p as ({PRODUCTS_SQL})
    select {FACT_COLUMNS_SQL}
    from o
    left join (select *, min(_StartDate) over (partition by CustomerID) as first from c) c
           on o.CustomerID = c.CustomerID and (o.OrderDate >= c._StartDate or c._StartDate = c.first)
               and (c._EndDate is null or o.OrderDate < c._EndDate)
    left join p on o.ProductID = p.ProductID""",
)
def fact_sales_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with the customer version that was valid at its date."""
    history = customer_history(spark, sf)
    headers = sales.with_customer_key_as_of(inputs.order_headers(spark, sf), history)
    return _fact(spark, sf, headers)


@query(
    "sales_summary",
    f"""
    with f as ({LINES_SQL})
    select cast(OrderDate as date) as OrderDate, {MEASURES_SQL}
    from f group by 1 order by 1""",
)
def sales_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales. Rows are added up per order before the order's date is
    looked up, so the join carries one row per order."""
    totals = sales.order_totals(inputs.order_amounts(spark, sf))
    dated = totals.join(inputs.order_headers(spark, sf).drop("CustomerID"), "OrderID")
    return _plain(sales.sales_summary_of_orders(dated))


@query(
    "sales_summary_raw_date",
    f"""
    with f as ({LINES_SQL})
    select OrderDate, {MEASURES_SQL}
    from f group by OrderDate order by OrderDate""",
)
def sales_summary_raw_date(spark: SparkSession, sf: str) -> DataFrame:
    """Grouped by the order timestamp itself, from rows that carry it."""
    rows = inputs.order_amounts(spark, sf).join(inputs.order_headers(spark, sf), "OrderID")
    return _plain(sales.sales_summary(rows, grain=None))


CUSTOMER_SUMMARY_SQL = f"""
    with f as ({LINES_SQL}), c as ({CUSTOMERS_SQL})
    select c.CustomerSK, c.CustomerID, c.CustomerName, c.City, c.State, c.Country, {MEASURES_SQL}
    from f left join c on f.CustomerID = c.CustomerID
    group by all"""


def _customer_summary(spark: SparkSession, sf: str, ordered: bool) -> DataFrame:
    dim = customers(spark, sf)
    totals = sales.order_totals(inputs.order_amounts(spark, sf))
    headers = sales.with_customer_key(inputs.order_headers(spark, sf), dim)
    keyed = totals.join(headers.select("OrderID", "CustomerSK"), "OrderID")
    return sales.customer_sales_summary_of_orders(keyed, dim, ordered=ordered)


@query("customer_sales_summary", CUSTOMER_SUMMARY_SQL + " order by TotalSales desc, CustomerSK")
def customer_sales_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_customer_summary(spark, sf, True), "CustomerSK", "CustomerID")


@query(
    "top_customers",
    f"""select * from ({CUSTOMER_SUMMARY_SQL})
    order by TotalSales desc, CustomerSK nulls first limit 10""",
)
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    summary = _customer_summary(spark, sf, False)
    return _plain(sales.top_customers(summary, 10), "CustomerSK", "CustomerID")
