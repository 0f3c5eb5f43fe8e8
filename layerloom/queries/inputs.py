"""The retail tables, as views over the test tables, in Spark and in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.columns import record_hash
from layerloom.operators.keys import keep_latest
from layerloom.queries.registry import table

MONEY = "decimal(18,2)"

# Days on which customer snapshots are loaded: early ones, so that many customers are
# still to come, and some have not ordered between the first two.
FIRST_LOAD = date(1996, 1, 1)
SECOND_LOAD = date(1996, 12, 1)
THIRD_LOAD = date(2001, 8, 1)

HASHED = [
    "CustomerName", "City", "State", "Country", "Balance", "Priority", "LastUpdated",
]
TRACKED = ["Priority"]


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Brand"),
        F.col("p_retailprice").cast(MONEY).alias("SellingPrice"),
    )


def customers_as_of(
    spark: SparkSession, sf: str, day: date | None, hashed: list[str] | None = None
) -> DataFrame:
    """Customers that had ordered by a day, with what was known about them then.

    Priority and LastUpdated come from the latest order up to that day, so
    snapshots of different days hold new, changed and unchanged customers.
    Without a day it is all customers, with or without orders.
    """
    orders = table(spark, sf, "orders")
    last = keep_latest(
        (orders if day is None else orders.where(F.col("o_orderdate") <= F.lit(day)))
        .select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
    )
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    snapshot = (
        table(spark, sf, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(last, F.col("c_custkey") == F.col("o_custkey"), "left" if day is None else "inner")
        .select(
            F.col("c_custkey").alias("CustomerID"),
            F.col("c_name").alias("CustomerName"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("State"),
            F.col("c_mktsegment").alias("Country"),
            F.col("c_acctbal").cast(MONEY).alias("Balance"),
            F.col("o_orderpriority").alias("Priority"),
            F.to_date("o_orderdate").alias("LastUpdated"),
        )
    )
    return snapshot.withColumn("_RecordHash", record_hash(snapshot, hashed or HASHED))


def customers_sql(day: date | None, hashed: list[str] | None = None) -> str:
    until = "true" if day is None else f"o_orderdate <= date '{day}'"
    values = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in hashed or HASHED)
    return f"""
    select *, sha256(concat_ws('||', {values})) as _RecordHash
    from (
      select c_custkey as CustomerID, c_name as CustomerName, n_name as City, r_name as State,
             c_mktsegment as Country, cast(c_acctbal as decimal(18,2)) as Balance,
             o_orderpriority as Priority, cast(o_orderdate as date) as LastUpdated
      from customer
      join nation on c_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey
      {"left" if day is None else ""} join (select *, row_number() over (partition by o_custkey
                                         order by o_orderdate desc, o_orderkey desc) as rn
            from orders where {until}) o
        on o_custkey = c_custkey and rn = 1
    )"""


def order_headers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("OrderDate"),
    )


def order_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """What the summaries need of the order rows. Discounted amounts have four
    digits, so that rounding them before they are added up would show."""
    price, discount = F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast("decimal(5,2)")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        (price * (1 - discount)).cast("decimal(18,4)").alias("TotalAmount"),
    )


def order_items(spark: SparkSession, sf: str, amount: str = MONEY) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").cast("decimal(5,2)").alias("Discount"),
        F.col("l_extendedprice").cast(amount).alias("TotalAmount"),
        F.col("l_shipdate").alias("ShipDate"),
    )


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows as the orders table of the retail model has them."""
    prices = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
    )
    return (
        order_items(spark, sf).join(order_headers(spark, sf), "OrderID").join(prices, "ProductID")
    )


ORDER_ROWS_SQL = """
    select l_orderkey as OrderID, o_custkey as CustomerID, l_partkey as ProductID,
           cast(l_quantity as integer) as Quantity,
           cast(p_retailprice as decimal(18,2)) as UnitPrice,
           cast(l_discount as decimal(5,2)) as Discount,
           cast(l_extendedprice as decimal(18,2)) as TotalAmount,
           o_orderdate as OrderDate, l_shipdate as ShipDate
    from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"""


def rates(spark: SparkSession, sf: str) -> DataFrame:
    """The latest rate per currency pair, quoted by the events."""
    quotes = table(spark, sf, "events").select(
        F.col("event_type").alias("BaseCurrency"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("TargetCurrency"),
        F.col("value").cast("decimal(18,6)").alias("ExchangeRate"),
        F.to_date("ts").alias("RateDate"),
        "ts",
        "event_id",
    )
    return keep_latest(quotes, ["TargetCurrency"], ["ts", "event_id"]).drop("ts", "event_id")


RATES_SQL = """
    select BaseCurrency, TargetCurrency, ExchangeRate, RateDate
    from (select event_type as BaseCurrency,
                 concat_ws('/', event_type, cast(user_id as varchar)) as TargetCurrency,
                 cast(value as decimal(18,6)) as ExchangeRate, cast(ts as date) as RateDate,
                 row_number() over (partition by event_type, user_id
                                    order by ts desc, event_id desc) as rn
          from events)
    where rn = 1"""
