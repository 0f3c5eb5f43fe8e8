"""The steps of the layers as a daily run takes them, on whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.metadata import Metadata
from layerloom.operators import sales
from layerloom.operators.incremental import FULL, INCREMENTAL, load_slice
from layerloom.operators.keys import dense_key, keep_latest
from layerloom.plans.ingest import to_bronze
from layerloom.plans.lake import Lake
from layerloom.plans.silver import to_silver
from layerloom.queries import inputs
from layerloom.queries.registry import query, run_at, table
from layerloom.queries.sales import (
    CUSTOMER_SUMMARY_SQL,
    CUSTOMERS_SQL,
    FACT_COLUMNS_SQL,
    MEASURES_SQL,
    PRODUCTS_SQL,
    _plain,
    customers,
)

RUN = run_at(date(2024, 2, 1), "batch-1")

ORDERS_TEXT_SQL = f"""
    select OrderID::varchar as OrderID, CustomerID::varchar as CustomerID, ProductID::varchar as ProductID,
           Quantity::varchar as Quantity, UnitPrice::varchar as UnitPrice, Discount::varchar as Discount,
           TotalAmount::varchar as TotalAmount,
           strftime(OrderDate, '%Y-%m-%d %H:%M:%S') as OrderDate,
           strftime(ShipDate, '%Y-%m-%d %H:%M:%S') as ShipDate
    from ({inputs.ORDER_ROWS_SQL})"""
ORDER_COLUMNS = [
    "OrderID", "CustomerID", "ProductID", "Quantity", "UnitPrice", "Discount", "TotalAmount",
    "OrderDate", "ShipDate",
]


def _bronze_orders(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.order_rows(spark, sf).select(ORDER_COLUMNS)
    return to_bronze(raw, RUN)


@query(
    "bronze_load",
    f"""select *, 'batch-1' as _BatchId, 'MANUAL_RUN' as _AdfPipelineRunId,
               sha256(concat_ws('||', {", ".join(ORDER_COLUMNS)})) as _RecordHash
        from ({ORDERS_TEXT_SQL})""",
)
def bronze_load(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows as the bronze layer stores them."""
    return _bronze_orders(spark, sf).drop("_IngestionTimestamp")


@query(
    "silver_load",
    f"""select OrderID::int as OrderID, CustomerID::int as CustomerID, ProductID::int as ProductID,
               Quantity, UnitPrice::double as UnitPrice, Discount::double as Discount,
               TotalAmount::double as TotalAmount, OrderDate::date as OrderDate, ShipDate::date as ShipDate,
               concat_ws(';', case when Discount > UnitPrice then 'Discount:VALID_DISCOUNT' end,
                 case when OrderDate > timestamp '2024-02-01' then 'OrderDate:NOT_FUTURE_DATE' end,
                 case when ShipDate < OrderDate then 'ShipDate:SHIP_AFTER_ORDER' end,
                 case when abs(TotalAmount - (Quantity * UnitPrice - Discount)) > 1
                      then 'TotalAmount:VALID_ORDER_TOTAL' end) as _FailedRules,
               _FailedRules <> '' as _IsRejected
        from ({inputs.ORDER_ROWS_SQL})""",
)
def silver_load(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze order rows with types and rules of the default metadata."""
    lake = Lake(spark, "", Metadata())
    rows = to_silver(lake, _bronze_orders(spark, sf), lake.metadata.table("orders"), RUN)
    plain = {c: "double" for c in ("UnitPrice", "Discount", "TotalAmount")} | {
        c: "date" for c in ("OrderDate", "ShipDate")
    }
    return rows.withColumns({c: F.col(c).cast(t) for c, t in plain.items()}).select(
        *ORDER_COLUMNS, "_FailedRules", "_IsRejected"
    )


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with both lookups, as the gold layer builds it."""
    products = dense_key(inputs.products(spark, sf), ["ProductID"], "ProductSK")
    return sales.fact_sales(inputs.order_rows(spark, sf), customers(spark, sf), products)


FACT_SQL = f"""
    with o as ({inputs.ORDER_ROWS_SQL}), c as ({CUSTOMERS_SQL}), p as ({PRODUCTS_SQL})
    select {FACT_COLUMNS_SQL}
    from o left join c on o.CustomerID = c.CustomerID left join p on o.ProductID = p.ProductID"""


@query("fact_from_dims", FACT_SQL)
def fact_from_dims(spark: SparkSession, sf: str) -> DataFrame:
    typed = {"OrderDate": "date"} | {c: "double" for c in ("UnitPrice", "Discount", "TotalAmount")}
    return _fact(spark, sf).withColumns({c: F.col(c).cast(t) for c, t in typed.items()})


AMOUNTS_SQL = f"""
    select OrderID, CustomerID, OrderDate, Quantity, TotalAmount from ({inputs.ORDER_ROWS_SQL})"""


@query(
    "daily_from_fact",
    f"""with f as ({AMOUNTS_SQL})
        select cast(OrderDate as date) as OrderDate, {MEASURES_SQL} from f group by 1""",
)
def daily_from_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(sales.sales_summary(_fact(spark, sf), grain="day", ordered=False))


@query(
    "customers_from_fact",
    f"""with f as ({AMOUNTS_SQL}), c as ({CUSTOMERS_SQL})
        {CUSTOMER_SUMMARY_SQL[CUSTOMER_SUMMARY_SQL.index("select c.CustomerSK") :]}""",
)
def customers_from_fact(spark: SparkSession, sf: str) -> DataFrame:
    dim = customers(spark, sf)
    products = dense_key(inputs.products(spark, sf), ["ProductID"], "ProductSK")
    fact = sales.fact_sales(inputs.order_rows(spark, sf), dim, products)
    return _plain(sales.customer_sales_summary(fact, dim, ordered=False), "CustomerSK", "CustomerID")


@query(
    "fx_latest",
    """select event_type as BaseCurrency, user_id::varchar as TargetCurrency,
              arg_max(value, (ts, event_id)) as ExchangeRate, max(ts)::date as RateDate,
              row_number() over (order by event_type, user_id::varchar) as ExchangeRateSK
       from events group by event_type, user_id""",
)
def fx_latest(spark: SparkSession, sf: str) -> DataFrame:
    """One rate per pair of currencies, the latest, numbered in the order of the pairs."""
    quotes = table(spark, sf, "events").select(
        F.col("event_type").alias("BaseCurrency"),
        F.col("user_id").cast("string").alias("TargetCurrency"),
        F.col("value").alias("ExchangeRate"),
        F.to_date("ts").alias("RateDate"),
        "ts",
        "event_id",
    )
    pair = ["BaseCurrency", "TargetCurrency"]
    return dense_key(keep_latest(quotes, pair, ["ts", "event_id"]).drop("ts", "event_id"), pair, "ExchangeRateSK")


@query(
    "load_types",
    """select 'FULL' as load_type, count(*) as n, max(event_id) as last from events
       union all
       select 'INCREMENTAL', count(*), max(event_id) from events where ts >= timestamp '2024-01-15'""",
)
def load_types(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a full and an incremental load take past the same mark."""
    events = table(spark, sf, "events").select("event_id", "ts")
    mark = F.lit("2024-01-15").cast("timestamp_ntz")
    result = None
    for kind in (FULL, INCREMENTAL):
        taken = load_slice(events, kind, "ts", mark, inclusive=True)
        counted = taken.agg(
            F.lit(kind).alias("load_type"), F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")
        )
        result = counted if result is None else result.union(counted)
    return result
