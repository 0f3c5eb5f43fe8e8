"""Incremental loads, freshness gates, counts and assertions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import checks
from layerloom.operators.incremental import INCREMENTAL, load_slice, next_mark
from layerloom.queries.registry import query, table

MARK = date(2024, 1, 15)
AS_OF = date(2024, 1, 20)
COUNTED = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "labels", "pages", "conversations", "embeddings", "benchmark",
]


@query("incremental_slice", f"select * from events where ts > date '{MARK}'")
def incremental_slice(spark: SparkSession, sf: str) -> DataFrame:
    return load_slice(table(spark, sf, "events"), INCREMENTAL, "ts", F.lit(MARK))


@query(
    "incremental_watermark",
    f"select count(*) as rows_loaded, max(ts) as new_mark from events where ts > date '{MARK}'",
)
def incremental_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return next_mark(table(spark, sf, "events"), "ts", F.lit(MARK).cast("timestamp_ntz"))


def _gated(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame | None, str]]:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return {
        "orders": (orders.select("o_orderdate"), "o_orderdate"),
        "customers": (table(spark, sf, "events").select("ts"), "ts"),
        "exchange_rates": (lines.select("l_shipdate"), "l_shipdate"),
    }


GATES_SQL = f"""
    select table_name, last_date, case when last_date is null then 'EMPTY'
             when last_date < date '{AS_OF}' then 'STALE' else 'FRESH' end as state,
           coalesce(last_date < date '{AS_OF}', true) as needs_load
    from (select 'orders' as table_name, cast(max(o_orderdate) as date) as last_date from orders
          union all select 'customers', cast(max(ts) as date) from events
          union all select 'exchange_rates', cast(max(l_shipdate) as date) from lineitem)"""


@query("freshness_gate", GATES_SQL)
def freshness_gate(spark: SparkSession, sf: str) -> DataFrame:
    return checks.freshness(spark, _gated(spark, sf), AS_OF)


@query(
    "freshness_document",
    f"""with g as ({GATES_SQL})
    select '{{"ingest_csv":"' || (select needs_load from g where table_name = 'orders')
        || '","ingest_customers":"' || (select needs_load from g where table_name = 'customers')
        || '","ingest_exchange_rate":"'
        || (select needs_load from g where table_name = 'exchange_rates')
        || '","publish_to_sql":"true","generation_mode":"daily_incremental"}}' as gates""",
)
def freshness_document(spark: SparkSession, sf: str) -> DataFrame:
    return checks.gate_document(checks.freshness(spark, _gated(spark, sf), AS_OF))


@query(
    "audit_counts",
    " union all ".join(
        f"select 'source' as layer, '{t}' as table_name, count(*) as record_count from {t}"
        for t in COUNTED
    ),
)
def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.row_counts({t: table(spark, sf, t) for t in COUNTED}, "source")


TESTS = {
    "orders Exists": ("orders", None),
    "lineitem Exists": ("lineitem", None),
    "customer Exists": ("customer", None),
    "customer in debt": ("customer", "c_acctbal < 0"),
    "order without total": ("orders", "o_totalprice is null"),
    "finished orders": ("orders", "o_orderstatus = 'F'"),
    "quantity above range": ("lineitem", "l_quantity > 50"),
}


@query(
    "layer_assertions",
    " union all ".join(
        f"""select '{name}' as test_name,
                   case when count(*) > 0 then 'PASS' else 'FAIL' end as status
            from {t} where {condition or 'true'}"""
        for name, (t, condition) in TESTS.items()
    )
    + " union all select 'returns Exists', 'FAIL'",
)
def layer_assertions(spark: SparkSession, sf: str) -> DataFrame:
    """One assertion per table and condition; the last table does not exist."""
    tests = {
        name: (table(spark, sf, t), None if condition is None else F.expr(condition))
        for name, (t, condition) in TESTS.items()
    }
    return checks.layer_assertions(spark, tests | {"returns Exists": (None, None)})
