"""The sales fact and its summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions import money
from layerloom.operators.asof import with_version_as_of

# Columns of the fact and of the customer summary.
FACT_MEASURES = ["Quantity", "UnitPrice", "Discount", "TotalAmount"]
DAY, PERIOD = "_Day", "_Period"
SUMMARY_CUSTOMER_COLUMNS = [
    "CustomerSK",
    "CustomerID",
    "CustomerName",
    "City",
    "State",
    "Country",
]


def with_customer_key(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Look up the customer key; ``customers`` must hold one row per customer."""
    return rows.join(customers.select("CustomerID", "CustomerSK"), "CustomerID", "left")


def with_product_key(rows: DataFrame, products: DataFrame) -> DataFrame:
    return rows.join(products.select("ProductID", "ProductSK"), "ProductID", "left")


def with_customer_key_as_of(
    rows: DataFrame, versions: DataFrame, when: str = "OrderDate", *, first_holds_before: bool = True
) -> DataFrame:
    """Look up the version that was valid at the row's date.

    Versions of a customer do not overlap, so a row matches at most one. The
    first version of a customer holds for earlier dates too, unless
    ``first_holds_before`` is off; then such rows keep a NULL key.
    """
    return with_version_as_of(
        rows,
        versions,
        "CustomerID",
        when,
        "CustomerSK",
        begins="_StartDate",
        ends="_EndDate",
        first_holds_before=first_holds_before,
    )


def fact_sales(
    orders: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    *,
    audit: Sequence[str] = (),
) -> DataFrame:
    """Order rows with the surrogate keys of customer and product.

    ``customers`` holds current versions only. Orders without a match keep NULL
    keys. A key the rows carry already (say, looked up on the order headers) is
    not looked up again. No join strategy is forced: dimensions under the
    broadcast threshold are broadcast, larger ones are sort-merged and skewed
    keys are split by adaptive execution.
    """
    if "CustomerSK" not in orders.columns:
        orders = with_customer_key(orders, customers)
    if "ProductSK" not in orders.columns:
        orders = with_product_key(orders, products)
    return orders.select(
        "OrderID",
        "OrderDate",
        "CustomerSK",
        "ProductSK",
        "CustomerID",
        "ProductID",
        *FACT_MEASURES,
        *audit,
    )


def order_totals(fact: DataFrame, *by: str) -> DataFrame:
    """One row per order: its quantity, exact amount and number of amounts.

    The common first step of the summaries. Counting these rows counts distinct
    orders, and an order with very many rows is reduced before any shuffle.
    """
    return fact.groupBy(*by, "OrderID").agg(
        F.sum("Quantity").alias("Quantity"),
        F.sum(money.exact(fact, "TotalAmount")).alias("Amount"),
        F.count("TotalAmount").alias("Amounts"),
    )


def _summed(totals: DataFrame, *by: str) -> DataFrame:
    return totals.groupBy(*by).agg(
        F.count("OrderID").alias("TotalOrders"),
        F.sum("Quantity").alias("TotalQuantity"),
        F.sum("Amount").alias("Amount"),
        F.sum("Amounts").alias("Amounts"),
    )


_SUMS = ["TotalOrders", "TotalQuantity", "Amount", "Amounts"]


def _finished(sums: DataFrame, *by: str) -> DataFrame:
    scale = sums.schema["Amount"].dataType.scale
    return sums.select(
        *by,
        "TotalOrders",
        "TotalQuantity",
        money.total(F.col("Amount")).alias("TotalSales"),
        money.mean(F.col("Amount"), F.col("Amounts"), scale).alias("AverageOrderValue"),
    )


def _at_grain(rows: DataFrame, grain: str | None) -> DataFrame:
    if grain is None:
        return rows
    when = F.to_date("OrderDate") if grain == "day" else F.date_trunc(grain, "OrderDate")
    return rows.withColumn("OrderDate", when)


def sales_summary(fact: DataFrame, *, grain: str | None = "day", ordered: bool = True) -> DataFrame:
    """Orders, quantity, sales and mean value per order date.

    ``grain=None`` groups by the order timestamp as it is.
    """
    totals = order_totals(_at_grain(fact, grain), "OrderDate")
    return sales_summary_of_orders(totals, grain=None, ordered=ordered)


def sales_summary_of_orders(
    totals: DataFrame, *, grain: str | None = "day", ordered: bool = True
) -> DataFrame:
    """The summary from ``order_totals`` that already carry their order date."""
    result = _finished(_summed(_at_grain(totals, grain), "OrderDate"), "OrderDate")
    return result.orderBy("OrderDate") if ordered else result


def customer_sales_summary(
    fact: DataFrame, customers: DataFrame, *, ordered: bool = True
) -> DataFrame:
    """The same measures per current customer, highest sales first.

    Orders whose key is not a current version share one row of NULLs.
    """
    return customer_sales_summary_of_orders(
        order_totals(fact, "CustomerSK"), customers, ordered=ordered
    )


def customer_sales_summary_of_orders(
    totals: DataFrame, customers: DataFrame, *, ordered: bool = True
) -> DataFrame:
    """The summary from ``order_totals`` that carry their customer key.

    An order belongs to one customer key, so orders are reduced to one row per
    key before they meet the dimension: the join sees no frequent keys, and the
    customers' attributes never travel with the order rows.
    """
    return _per_customer(_summed(totals, "CustomerSK"), customers, ordered)


def _per_customer(per_key: DataFrame, customers: DataFrame, ordered: bool) -> DataFrame:
    per_key = per_key.alias("k")
    dim = customers.select(*SUMMARY_CUSTOMER_COLUMNS).alias("c")
    joined = per_key.join(dim, F.col("k.CustomerSK") == F.col("c.CustomerSK"), "left")
    # Adds up nothing but the keys without a current version.
    sums = joined.groupBy(*[F.col(f"c.{c}") for c in SUMMARY_CUSTOMER_COLUMNS]).agg(
        *[F.sum(c).alias(c) for c in _SUMS]
    )
    result = _finished(sums, *SUMMARY_CUSTOMER_COLUMNS)
    return result.orderBy(F.desc("TotalSales"), F.asc("CustomerSK")) if ordered else result


def with_period(rows: DataFrame, grain: str = "month") -> DataFrame:
    """Add the period of the order date: the unit in which the sales tables are rewritten."""
    return rows.withColumn(PERIOD, F.to_date(F.date_trunc(grain, "OrderDate")))


def customer_days(fact: DataFrame) -> DataFrame:
    """What each customer ordered on each day: the rows that both summaries add up.

    The rows of an order have one date and one customer. Orders hold few rows, so
    adding them up before the shuffle would save nothing and fill the memory of
    its tasks: the rows of a customer and day are brought together once, for both steps.
    """
    by = [PERIOD, DAY, "CustomerID", "CustomerSK"]
    rows = fact.withColumn(DAY, F.to_date("OrderDate")).select(*by, "OrderID", "Quantity", "TotalAmount")
    return _summed(order_totals(rows.repartition("CustomerID", DAY), *by), *by)


def _added_up(days: DataFrame, *by: str) -> DataFrame:
    return days.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _SUMS])


def sales_summary_of_days(days: DataFrame) -> DataFrame:
    """The daily summary from ``customer_days``."""
    return _finished(_added_up(days, DAY), DAY).withColumnRenamed(DAY, "OrderDate")


def customer_sales_summary_of_days(days: DataFrame, customers: DataFrame) -> DataFrame:
    """The customer summary from ``customer_days``, unsorted."""
    return _per_customer(_added_up(days, "CustomerSK"), customers, ordered=False)


def top_customers(summary: DataFrame, n: int) -> DataFrame:
    """The n customers with the highest sales; ties go to the lower key."""
    return summary.orderBy(F.desc("TotalSales"), F.asc("CustomerSK")).limit(n)
