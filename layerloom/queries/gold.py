"""The sales tables after two loads, of which the second rewrites only the months it touches."""

from __future__ import annotations

import uuid
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.plans import gold
from layerloom.plans.lake import GOLD, SILVER, Lake
from layerloom.plans.silver import OUTCOME, VALID
from layerloom.queries import dimensions, inputs
from layerloom.queries.dimensions import FIRST, MERGED_SQL, SECOND, VERSION_SQL
from layerloom.queries.inputs import FIRST_LOAD, SECOND_LOAD
from layerloom.queries.registry import query, run_at, table
from layerloom.queries.sales import CUSTOMER_SUMMARY_SQL, FACT_COLUMNS_SQL, MEASURES_SQL, PRODUCTS_SQL, _plain
from layerloom.storage import shared_folder, staged


def _order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that both loads are made of, written down. Every row is an order
    of its own, as in the retail model."""
    lines = (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
        # One shuffle for the sums, which join few rows each, and for the headers.
        .repartition("l_orderkey")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.max("l_partkey").alias("ProductID"),
            F.sum("l_quantity").cast("int").alias("Quantity"),
            F.max("l_discount").cast("decimal(5,2)").alias("Discount"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("TotalAmount"),
        )
    )
    rows = (
        lines.join(inputs.order_headers(spark, sf), F.col("l_orderkey") == F.col("OrderID"))
        .join(inputs.products(spark, sf), "ProductID")
        .select(
            (F.col("OrderID") * 10 + F.col("l_linenumber")).alias("OrderID"),
            "CustomerID",
            "ProductID",
            "Quantity",
            F.col("SellingPrice").alias("UnitPrice"),
            "Discount",
            "TotalAmount",
            F.col("OrderDate").cast("timestamp").alias("OrderDate"),
        )
    )
    return staged(rows, "order-rows", "zstd")


def _orders(rows: DataFrame, load: int) -> DataFrame:
    """Rows of the first load, or of the second: later orders, and some earlier ones
    that are sent again, with another quantity and a day later."""
    early = F.col("OrderDate") <= F.lit(FIRST_LOAD)
    if load == 1:
        return rows.where(early)
    again = rows.where(early & (F.col("OrderID") % 500 < 10)).withColumns(
        {"Quantity": F.col("Quantity") + 1, "OrderDate": F.col("OrderDate") + F.expr("interval 1 day")}
    )
    return rows.where(~early).unionByName(again)


ORDERS_SQL = f"""
    select OrderID, o_custkey as CustomerID, ProductID, cast(Quantity + again::int as integer) as Quantity,
           cast(p_retailprice as decimal(18,2)) as UnitPrice, Discount, TotalAmount,
           o_orderdate + (again::int * interval 1 day) as OrderDate
    from (select *, o_orderdate <= date '{FIRST_LOAD}' and OrderID % 500 < 10 as again
          from (select l_orderkey, l_orderkey * 10 + l_linenumber as OrderID, max(l_partkey) as ProductID,
                       cast(sum(l_quantity) as integer) as Quantity, cast(max(l_discount) as decimal(5,2)) as Discount,
                       cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as TotalAmount
                from lineitem group by l_orderkey, l_linenumber)
          join orders on l_orderkey = o_orderkey join part on ProductID = p_partkey)"""
CUSTOMERS_SQL = f"select * from {MERGED_SQL} where _IsCurrent"


def _silver(lake: Lake, name: str, rows: DataFrame, run: RunContext) -> None:
    names = run.columns
    stamps = {names.processed_at: run.timestamp(), names.batch_id: F.lit(run.batch_id), names.run_id: F.lit(run.run_id)}
    if names.record_hash not in rows.columns:
        stamps[names.record_hash] = F.lit("")
    stamped = rows.withColumns(stamps).withColumns({names.failed_rules: F.lit(""), OUTCOME: F.lit(VALID)})
    lake.write(stamped, SILVER, name, run, partition_by=[OUTCOME])


@lru_cache(maxsize=4)
def two_loads(spark: SparkSession, sf: str) -> Lake:
    """A lake whose sales tables were built by one load and brought up to date by another.

    The queries of a session read the same one.
    """
    lake = Lake(spark, f"{shared_folder(spark)}/gold-{uuid.uuid4().hex}")
    tables = {name: lake.metadata.table(name) for name in ("customers", "products", "orders")}
    order_rows = _order_rows(spark, sf)
    for load, run, day in ((1, FIRST, FIRST_LOAD), (2, SECOND, SECOND_LOAD)):
        _silver(lake, "customers", inputs.customers_as_of(spark, sf, day), run)
        _silver(lake, "products", inputs.products(spark, sf), run)
        _silver(lake, "orders", _orders(order_rows, load), run)
        gold.load_versions(lake, tables["customers"], "customer_dim", run, "CustomerID")
        gold.load_dimension(lake, tables["products"], "product_dim", run)
        gold.load_fact(lake, tables["orders"], run)
        gold.load_summaries(lake, run)
    return lake


@query(
    "fact_incremental",
    f"""with o as ({ORDERS_SQL}), c as ({CUSTOMERS_SQL}), p as ({PRODUCTS_SQL})
        select {FACT_COLUMNS_SQL}
        from o left join c on o.CustomerID = c.CustomerID left join p on o.ProductID = p.ProductID""",
)
def fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    lake = two_loads(spark, sf)
    fact = gold.gold_table(lake, gold.FACT_TABLE).drop("_BatchId", "_AdfPipelineRunId", "_ProcessedTimestamp")
    plain = {"OrderDate": "date"} | {c: "double" for c in ("UnitPrice", "Discount", "TotalAmount")}
    return fact.withColumns({c: F.col(c).cast(t) for c, t in plain.items()})


@query(
    "daily_incremental",
    f"with f as ({ORDERS_SQL}) select cast(OrderDate as date) as OrderDate, {MEASURES_SQL} from f group by 1",
)
def daily_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(two_loads(spark, sf).read(GOLD, gold.SALES_SUMMARY))


@query(
    "customers_incremental",
    f"""with f as ({ORDERS_SQL}), c as ({CUSTOMERS_SQL})
        {CUSTOMER_SUMMARY_SQL[CUSTOMER_SUMMARY_SQL.index("select c.CustomerSK") :]}""",
)
def customers_incremental(spark: SparkSession, sf: str) -> DataFrame:
    summary = two_loads(spark, sf).read(GOLD, gold.CUSTOMER_SALES_SUMMARY)
    return _plain(summary, "CustomerSK", "CustomerID")


#: Small, so that the given customers fill many ranges.
RANGE_KEYS = 20
#: As many keys share a folder as in a range of the usual size.
FOLDER_RANGES = gold.RANGE_KEYS // RANGE_KEYS
#: A few days after the second load, so that most ranges stay as they are.
LATE_LOAD = date(1996, 12, 4)
LATE = run_at(LATE_LOAD, "batch-late")
LATE_SQL = dimensions._merge_sql(f"select * from {MERGED_SQL}", LATE_LOAD)


@lru_cache(maxsize=4)
def three_loads(spark: SparkSession, sf: str) -> Lake:
    """A lake whose customers were loaded three times, in small ranges of keys."""
    lake = Lake(spark, f"{shared_folder(spark)}/ranges-{uuid.uuid4().hex}")
    config = lake.metadata.table("customers")
    for run, day in ((FIRST, FIRST_LOAD), (SECOND, SECOND_LOAD), (LATE, LATE_LOAD)):
        _silver(lake, "customers", inputs.customers_as_of(spark, sf, day), run)
        gold.load_versions(
            lake, config, "customer_dim", run, "CustomerID", range_keys=RANGE_KEYS, folder_ranges=FOLDER_RANGES
        )
    return lake


@query("scd2_ranges", f"select {VERSION_SQL} from {LATE_SQL}")
def scd2_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """All versions after three loads, read from the ranges that each load rewrote."""
    rows = gold.versions(three_loads(spark, sf), "customer_dim")
    return dimensions._plain(rows.drop("_BatchId", "_AdfPipelineRunId", "_ProcessedTimestamp"))


@query(
    "scd2_range_writes",
    f"""select (CustomerSK - 1) // {RANGE_KEYS} as key_range,
               case when max(greatest(_StartDate, coalesce(_EndDate, _StartDate))) = date '{LATE_LOAD}' then '{LATE.batch_id}'
                    when max(greatest(_StartDate, coalesce(_EndDate, _StartDate))) = date '{SECOND_LOAD}' then '{SECOND.batch_id}'
                    else '{FIRST.batch_id}' end as batch_id,
               count(*) filter (_IsCurrent) as n_current, max(max(CustomerSK)) over () as highest_key
        from {LATE_SQL} group by 1""",
)
def scd2_range_writes(spark: SparkSession, sf: str) -> DataFrame:
    """Which load wrote each range last: the last one that opened or closed a version in it."""
    lake = three_loads(spark, sf)
    ranges = gold.key_ranges(lake, "customer_dim", LATE.batch_id).drop("range_keys", "folder_ranges")
    held = gold.current_versions(lake, "customer_dim").groupBy(F.expr(f"(CustomerSK - 1) div {RANGE_KEYS}").alias("key_range"))
    counted = held.agg(F.count(F.lit(1)).alias("n"))
    return ranges.join(counted, "key_range", "left").select(
        "key_range", "batch_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_current"), "highest_key"
    )
