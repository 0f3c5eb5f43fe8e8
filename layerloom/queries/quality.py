"""Data-quality queries. Each rule runs over a whole table."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.metadata import RULES
from layerloom.operators.rules import ERROR, WARNING, Rule
from layerloom.operators.validate import (
    failure_counts,
    mark,
    rejected_rows,
    valid_rows,
    violations_of,
    with_copies,
)
from layerloom.queries import inputs
from layerloom.queries.registry import query, run_at, table

AS_OF = date(2000, 1, 1)
RUN = run_at(AS_OF, "batch-1")


def _violations(df: DataFrame, column: str, rule: str, **args) -> DataFrame:
    return violations_of(df, Rule(column, rule, args=args), AS_OF)


@query(
    "dq_not_null",
    """select d.doc_id, d.lang, l.quality from documents d left join labels l using (doc_id)
       where l.quality is null""",
)
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return _violations(documents.join(labels, "doc_id", "left"), "quality", "NOT_NULL")


# Loose on purpose: finds anything that may be meant as an address or a number.
# Starting at a blank keeps the search linear in the length of the text.
ADDRESS_LIKE = r"(^|[ \t\r\n])([^ \t\r\n]*@[^ \t\r\n]*)"
NUMBER_LIKE = r"[0-9+][0-9() -]{6,}[0-9]"


def _addresses() -> Column:
    """All addresses of a text. Only texts with an at sign are searched."""
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(ADDRESS_LIKE), F.lit(2))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))


def _numbers() -> Column:
    found = F.regexp_extract_all("text", F.lit(NUMBER_LIKE), F.lit(0))
    return F.transform(found, lambda n: F.regexp_replace(n, "[ ()-]", ""))


def _each(spark: SparkSession, sf: str, values: Column, name: str) -> DataFrame:
    """One row per value found in a document."""
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", F.explode(values).alias(name))


@query(
    "dq_not_empty",
    f"""select doc_id, email
        from (select doc_id, array_to_string(regexp_extract_all(text, '{ADDRESS_LIKE}', 2), ' ') as email
              from documents)
        where trim(email) = ''""",
)
def dq_not_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without any address."""
    found = table(spark, sf, "documents").select("doc_id", F.array_join(_addresses(), " ").alias("email"))
    return _violations(found, "email", "NOT_EMPTY")


@query(
    "dq_email",
    f"""select doc_id, email
        from (select doc_id, unnest(regexp_extract_all(text, '{ADDRESS_LIKE}', 2)) as email from documents)
        where not regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$')""",
)
def dq_email(spark: SparkSession, sf: str) -> DataFrame:
    """Every address of every document."""
    found = _each(spark, sf, _addresses(), "email")
    return _violations(found, "email", "VALID_EMAIL")


@query(
    "dq_phone",
    f"""select doc_id, phone
        from (select doc_id, regexp_replace(n, '[ ()-]', '', 'g') as phone
              from (select doc_id, unnest(regexp_extract_all(text, '{NUMBER_LIKE}')) as n from documents))
        where not regexp_matches(phone, '^\\d{{10}}$')""",
)
def dq_phone(spark: SparkSession, sf: str) -> DataFrame:
    """Every long number of every document."""
    found = _each(spark, sf, _numbers(), "phone")
    return _violations(found, "phone", "VALID_PHONE")


@query("dq_positive", "select c_custkey, c_acctbal from customer where c_acctbal <= 0")
def dq_positive(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return _violations(customers, "c_acctbal", "POSITIVE_NUMBER")


ALLOWED = {
    "VALID_CATEGORY": ("part", "p_partkey", "p_type", ["SMALL", "MEDIUM", "LARGE"]),
    "VALID_PRODUCT_STATUS": ("orders", "o_orderkey", "o_orderstatus", ["F", "O"]),
    "VALID_COUNTRY": ("customer", "c_custkey", "c_mktsegment", ["BUILDING", "MACHINERY"]),
    "VALID_CURRENCY": ("region", "r_regionkey", "r_name", ["ASIA", "EUROPE"]),
}


@query(
    "dq_allowed_values",
    " union all ".join(
        f"""select '{rule}' as rule, '{t}' as table_name, cast({key} as bigint) as id,
                   {column} as value
            from {t} where {column} not in ({", ".join(f"'{v}'" for v in allowed)})"""
        for rule, (t, key, column, allowed) in ALLOWED.items()
    ),
)
def dq_allowed_values(spark: SparkSession, sf: str) -> DataFrame:
    result = None
    for rule, (name, key, column, allowed) in ALLOWED.items():
        found = _violations(
            table(spark, sf, name).select(key, column), column, rule, allowed=allowed
        ).select(
            F.lit(rule).alias("rule"),
            F.lit(name).alias("table_name"),
            F.col(key).cast("bigint").alias("id"),
            F.col(column).alias("value"),
        )
        result = found if result is None else result.unionByName(found)
    return result


@query(
    "dq_discount",
    """select l_orderkey, l_linenumber, l_discount, l_tax from lineitem
       where l_discount > l_tax""",
)
def dq_discount(spark: SparkSession, sf: str) -> DataFrame:
    """The discount rate must not exceed the other rate of the line."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )
    return _violations(lines, "l_discount", "VALID_DISCOUNT", discount="l_discount", price="l_tax")


@query(
    "dq_order_total",
    f"""select OrderID, ProductID, cast(TotalAmount as double) as TotalAmount
        from ({inputs.ORDER_ROWS_SQL})
        where abs(TotalAmount - (Quantity * UnitPrice - Discount)) > 1""",
)
def dq_order_total(spark: SparkSession, sf: str) -> DataFrame:
    found = _violations(inputs.order_rows(spark, sf), "TotalAmount", "VALID_ORDER_TOTAL")
    return found.select("OrderID", "ProductID", F.col("TotalAmount").cast("double"))


@query(
    "dq_order_total_percent",
    f"""select OrderID, ProductID, cast(TotalAmount as double) as TotalAmount
        from ({inputs.ORDER_ROWS_SQL})
        where abs(TotalAmount - Quantity * UnitPrice * (1 - Discount)) > 1""",
)
def dq_order_total_percent(spark: SparkSession, sf: str) -> DataFrame:
    """The discount as a share of the price."""
    found = _violations(
        inputs.order_rows(spark, sf),
        "TotalAmount",
        "VALID_ORDER_TOTAL",
        expected="Quantity * UnitPrice * (1 - Discount)",
    )
    return found.select("OrderID", "ProductID", F.col("TotalAmount").cast("double"))


@query(
    "dq_not_future",
    f"select o_orderkey, o_orderdate from orders where o_orderdate > date '{AS_OF}'",
)
def dq_not_future(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return _violations(orders, "o_orderdate", "NOT_FUTURE_DATE")


NOON = "2024-01-15 12:00:00"


@query(
    "dq_not_future_clock",
    f"select event_id, ts from events where ts > timestamp '{NOON}'",
)
def dq_not_future_clock(spark: SparkSession, sf: str) -> DataFrame:
    """Against a moment of the day, as a metadata row gives it."""
    events = table(spark, sf, "events").select("event_id", "ts")
    return _violations(events, "ts", "NOT_FUTURE_DATE", now=NOON)


@query(
    "dq_dob",
    f"select o_orderkey, o_orderdate from orders where o_orderdate >= date '{AS_OF}'",
)
def dq_dob(spark: SparkSession, sf: str) -> DataFrame:
    """The date of birth rule, on order dates: the day itself is a violation."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return _violations(orders, "o_orderdate", "VALID_DOB")


@query(
    "dq_ship_after_order",
    """select l_orderkey, l_linenumber, l_shipdate, o_orderdate
       from lineitem join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate""",
)
def dq_ship_after_order(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return _violations(
        joined, "l_shipdate", "SHIP_AFTER_ORDER", shipped="l_shipdate", ordered="o_orderdate"
    )


@query(
    "dq_sell_ge_cost",
    """select l_orderkey, l_linenumber, l_partkey, price::double as price, cost::double as cost
       from (select l_orderkey, l_linenumber, l_partkey,
                    l_extendedprice::decimal(18,2) as price,
                    p_retailprice::decimal(18,2) * l_quantity::integer as cost
             from lineitem join part on l_partkey = p_partkey)
       where price < cost""",
)
def dq_sell_ge_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Lines sold below the list price of their quantity."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    listed = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast("decimal(18,2)")
    )
    priced = lines.join(listed, "l_partkey").withColumn(
        "cost", F.col("p_retailprice") * F.col("quantity")
    )
    found = _violations(priced, "price", "SELL_PRICE_GE_COST", price="price", cost="cost")
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("price").cast("double"),
        F.col("cost").cast("double"),
    )


@query(
    "dq_duplicates",
    """select l_orderkey, l_linenumber, l_partkey, l_shipdate, _Copies
       from (select *, count(*) over (partition by l_orderkey, l_linenumber) as _Copies
             from lineitem)
       where _Copies > 1""",
)
def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    counted = with_copies(lines, ["l_orderkey", "l_linenumber"])
    return _violations(counted, "l_orderkey", "UNIQUE")


LAST_SEGMENT = "/([^/?]*)([?].*)?$"


@query(
    "dq_castable",
    f"""select page_id, segment
        from (select page_id, regexp_extract(url, '{LAST_SEGMENT}', 1) as segment from pages)
        where segment is not null and try_cast(segment as integer) is null""",
)
def dq_castable(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose last path segment is not a whole number."""
    pages = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("url", LAST_SEGMENT, 1).alias("segment")
    )
    return _violations(pages, "segment", "CASTABLE", type="INT")


CUSTOMER_RULES = [
    Rule("c_acctbal", "POSITIVE_NUMBER", ERROR),
    Rule("c_mktsegment", "VALID_CATEGORY", WARNING, {"allowed": ["BUILDING", "MACHINERY"]}),
    Rule("c_name", "MATCHES", ERROR, {"pattern": "^Customer#[0-9]{8}[1-9]$"}),
]
MARKED_SQL = f"""
    select c_custkey, c_name, c_acctbal, c_mktsegment,
           concat_ws(';', case when c_acctbal <= 0 then 'c_acctbal:POSITIVE_NUMBER' end,
                     case when c_mktsegment not in ('BUILDING', 'MACHINERY')
                          then 'c_mktsegment:VALID_CATEGORY' end,
                     case when not regexp_matches(c_name, '^Customer#[0-9]{{8}}[1-9]$')
                          then 'c_name:MATCHES' end) as _FailedRules,
           date '{AS_OF}' as _ProcessedTimestamp
    from customer"""


def _marked(spark: SparkSession, sf: str, **options) -> DataFrame:
    customers = table(spark, sf, "customer").drop("c_nationkey")
    marked = mark(customers, CUSTOMER_RULES, RUN, **options)
    return marked.withColumn("_ProcessedTimestamp", F.to_date("_ProcessedTimestamp"))


@query(
    "dq_valid",
    f"""select * exclude (_FailedRules), false as _IsRejected from ({MARKED_SQL})
        where _FailedRules = ''""",
)
def dq_valid(spark: SparkSession, sf: str) -> DataFrame:
    return valid_rows(_marked(spark, sf), RUN)


@query(
    "dq_reject",
    f"select *, true as _IsRejected from ({MARKED_SQL}) where _FailedRules <> ''",
)
def dq_reject(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_rows(_marked(spark, sf), RUN)


@query(
    "dq_severity",
    f"""select *, (_FailedRules like '%c_acctbal:%' or _FailedRules like '%c_name:%') as _IsRejected
        from ({MARKED_SQL})""",
)
def dq_severity(spark: SparkSession, sf: str) -> DataFrame:
    """Warnings are recorded but do not reject."""
    return _marked(spark, sf, severity_aware=True)


def _default_rules(name: str) -> list[Rule]:
    return [
        Rule(r.column_name, r.validation_rule, r.severity, json.loads(r.arguments or "{}"))
        for r in RULES
        if r.table_name == name
    ]


# (table, column, rule, severity, violation) for every default rule that applies.
SUMMARY_CHECKS = [
    ("orders", "OrderID", "NOT_NULL", "ERROR", "OrderID is null"),
    ("orders", "CustomerID", "NOT_NULL", "ERROR", "CustomerID is null"),
    ("orders", "ProductID", "NOT_NULL", "ERROR", "ProductID is null"),
    ("orders", "Quantity", "POSITIVE_NUMBER", "ERROR", "Quantity <= 0"),
    ("orders", "UnitPrice", "POSITIVE_NUMBER", "ERROR", "UnitPrice <= 0"),
    ("orders", "Discount", "VALID_DISCOUNT", "ERROR", "Discount > UnitPrice"),
    ("orders", "OrderDate", "NOT_FUTURE_DATE", "ERROR", f"OrderDate > date '{AS_OF}'"),
    ("orders", "ShipDate", "SHIP_AFTER_ORDER", "ERROR", "ShipDate < OrderDate"),
    ("orders", "TotalAmount", "VALID_ORDER_TOTAL", "ERROR",
     "abs(TotalAmount - (Quantity * UnitPrice - Discount)) > 1"),
    ("orders", "ProductID", "UNIQUE", "WARNING",
     "count(*) over (partition by OrderID, ProductID) > 1"),
    ("products", "ProductID", "NOT_NULL", "ERROR", "ProductID is null"),
    ("products", "ProductName", "NOT_EMPTY", "ERROR", "trim(ProductName) = ''"),
    ("products", "Category", "VALID_CATEGORY", "ERROR",
     "Category not in ('Electronics','Clothing','Furniture','Grocery','Sports','Books')"),
    ("customers", "CustomerID", "NOT_NULL", "ERROR", "CustomerID is null"),
    ("customers", "CustomerName", "NOT_EMPTY", "ERROR", "trim(CustomerName) = ''"),
    ("customers", "Country", "VALID_COUNTRY", "WARNING",
     "Country not in ('India','USA','Canada','UK','Australia')"),
    ("customers", "LastUpdated", "NOT_NULL", "ERROR", "LastUpdated is null"),
    ("exchange_rates", "BaseCurrency", "VALID_CURRENCY", "ERROR",
     "BaseCurrency not in ('USD','INR','EUR','GBP','AUD','CAD','JPY')"),
    ("exchange_rates", "TargetCurrency", "VALID_CURRENCY", "ERROR",
     "TargetCurrency not in ('USD','INR','EUR','GBP','AUD','CAD','JPY')"),
    ("exchange_rates", "ExchangeRate", "POSITIVE_NUMBER", "ERROR", "ExchangeRate <= 0"),
    ("exchange_rates", "RateDate", "NOT_FUTURE_DATE", "ERROR", f"RateDate > date '{AS_OF}'"),
]


# A product that stands in an order more than once.
REPEATED = [Rule("ProductID", "UNIQUE", WARNING, {"keys": ["OrderID", "ProductID"]})]


@query(
    "dq_summary",
    f"""
    with orders_rows as ({inputs.ORDER_ROWS_SQL}),
    products_rows as (select p_partkey as ProductID, p_name as ProductName, p_type as Category
                      from part),
    customers_rows as ({inputs.customers_sql(inputs.THIRD_LOAD)}),
    exchange_rates_rows as ({inputs.RATES_SQL})
    """
    + " union all ".join(
        f"""select '{t}' as table_name, '{c}' as column_name, '{r}' as rule, '{s}' as severity,
                   count(*) as checked, count(*) filter (v) as failed
            from (select {v} as v from {t}_rows)"""
        for t, c, r, s, v in SUMMARY_CHECKS
    ),
)
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All default rules on all four retail tables, one scan of each."""
    tables = {
        "orders": inputs.order_rows(spark, sf),
        "products": inputs.products(spark, sf),
        "customers": inputs.customers_as_of(spark, sf, inputs.THIRD_LOAD),
        "exchange_rates": inputs.rates(spark, sf),
    }
    result = None
    for name, df in tables.items():
        rules = _default_rules(name) + (REPEATED if name == "orders" else [])
        counted = failure_counts(df, rules, AS_OF, name)
        result = counted if result is None else result.unionByName(counted)
    return result
