"""The whole warehouse over two days on generated retail tables."""

import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.functions.columns import update_where
from layerloom.metadata import DqConfig, Metadata
from layerloom.operators import scd
from layerloom.plans import checks, gold, silver
from layerloom.plans.daily import run_daily
from layerloom.plans.ingest import Sources
from layerloom.plans.lake import BRONZE, GOLD, LANDING, SILVER, Lake
from layerloom.plans.publish import publish
from layerloom.sources import files, retail

DAY_1, DAY_2 = date(2024, 5, 1), date(2024, 5, 2)
N_PRODUCTS, N_CUSTOMERS, N_ORDERS = 40, 150, 600


def run_on(day: date) -> RunContext:
    return RunContext(
        "MANUAL_RUN", f"b{day:%Y%m%d}", datetime(day.year, day.month, day.day, 3), day
    )


def count(df):
    return df.count()


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Sources of day 1, a run, changed sources of day 2, another run."""
    base = tmp_path_factory.mktemp("lake")
    folder = tmp_path_factory.mktemp("sources")
    # The category list must know the generated categories.
    metadata = Metadata()
    rules = [
        DqConfig(*r.__dict__.values())
        if r.validation_rule not in ("VALID_CATEGORY", "VALID_ORDER_TOTAL")
        else DqConfig(
            r.table_name,
            r.column_name,
            r.validation_rule,
            r.severity,
            json.dumps(
                {"allowed": list(retail.CATEGORIES)}
                if r.validation_rule == "VALID_CATEGORY"
                else {"expected": "Quantity * UnitPrice * (1 - Discount / 100)"}
            ),
        )
        for r in metadata.rules
    ]
    lake = Lake(spark, str(base), Metadata(rules=rules))
    lake.save_metadata()
    lake = Lake.open(spark, str(base))

    def put(name, df):
        files.write_csv(df, str(folder / name), single_file=True)

    customers = retail.customers(spark, DAY_1, N_CUSTOMERS)
    put("products", retail.products(spark, N_PRODUCTS))
    put("customers", customers)
    put("orders", retail.orders(spark, DAY_1, N_ORDERS, N_CUSTOMERS, N_PRODUCTS))
    (folder / "exchange_rates").mkdir()
    answer = {"base_code": "USD", "conversion_rates": {"INR": 83.1, "EUR": 0.92, "XXX": 5, "GBP": 0}}
    saved = folder / "exchange_rates" / "answer.json"
    saved.write_text(json.dumps(answer, indent=1))
    noon = datetime(2024, 5, 1, 12, tzinfo=timezone.utc).timestamp()
    os.utime(saved, (noon, noon))
    sources = Sources(str(folder))
    first = run_daily(lake, sources, run_on(DAY_1))

    # Customer 101 moves, two customers are new; the others are sent again.
    moved = update_where(
        customers,
        F.col("CustomerID") == 101,
        {
            "City": "Chennai (new)",
            "Email": "customer101_new@gmail.com",
            "LastUpdated": F.lit("2024-05-01 12:00:00").cast("timestamp"),
        },
    )
    added = (
        retail.customers(spark, DAY_1, N_CUSTOMERS + 2)
        .where(F.col("CustomerID") > N_CUSTOMERS)
        .withColumn("LastUpdated", F.lit("2024-05-01 13:00:00").cast("timestamp"))
    )
    put("customers", moved.unionByName(added))
    second = run_daily(lake, sources, run_on(DAY_2))
    return lake, first, second


def by_name(rows):
    return {(r.layer, r.table_name): r for r in rows}


def test_every_layer_is_written(world):
    lake, first, _ = world
    rows = by_name(first)
    assert rows[LANDING, "customers"].records_written == N_CUSTOMERS
    assert rows[BRONZE, "orders"].records_written == N_ORDERS
    assert rows[SILVER, "products"].records_written == N_PRODUCTS
    assert rows[SILVER, "orders"].records_read == N_ORDERS
    assert rows[SILVER, "orders"].records_rejected == 0
    assert rows[GOLD, "fact_sales"].records_written == N_ORDERS
    assert rows[GOLD, "customer_dim"].records_written == N_CUSTOMERS
    assert all(r.status == "SUCCESS" for r in first)


def test_bronze_is_all_strings_with_a_stable_hash(world):
    lake, *_ = world
    bronze = lake.read(BRONZE, "products")
    kinds = {f.name: f.dataType.simpleString() for f in bronze.schema.fields}
    assert kinds.pop("_IngestionTimestamp") == "timestamp"
    assert set(kinds.values()) == {"string"}
    hashes = lake.read_batches(BRONZE, "products").select("_RecordHash").distinct()
    assert count(hashes) == N_PRODUCTS  # the same rows on both days


def test_incremental_slice_starts_at_the_mark(world):
    lake, first, second = world
    mark = by_name(first)[SILVER, "customers"].watermark
    landed = by_name(second)[LANDING, "customers"].records_written
    all_rows = lake.read_batches(SILVER, "customers")
    same = all_rows.where(
        (F.col("_BatchId") == "b20240501") & (F.col("LastUpdated") == F.lit(str(mark)).cast("timestamp"))
    )
    assert landed == 3 + count(same.select("CustomerID").distinct())
    assert by_name(second)[SILVER, "customers"].watermark == datetime(2024, 5, 1, 13)


def test_rates_are_unpivoted_and_rejected_with_reasons(world):
    lake, *_ = world
    config = lake.metadata.table("exchange_rates")
    rejected = {
        r["TargetCurrency"]: r["_FailedRules"] for r in silver.rejected_rows(lake, config).collect()
    }
    assert rejected == {
        "XXX": "TargetCurrency:VALID_CURRENCY",
        "GBP": "ExchangeRate:POSITIVE_NUMBER",
    }
    dim = lake.read(GOLD, "exchange_rate_dim").orderBy("ExchangeRateSK").collect()
    assert [(r["TargetCurrency"], r["ExchangeRateSK"]) for r in dim] == [("EUR", 1), ("INR", 2)]


def test_changed_customer_gets_a_second_version(world):
    lake, *_ = world
    dim = gold.versions(lake, "customer_dim")
    versions = dim.where("CustomerID = 101").orderBy("CustomerSK").collect()
    assert [(v["_IsCurrent"], v["_EndDate"] is None) for v in versions] == [
        (False, False),
        (True, True),
    ]
    assert versions[0]["_EndDate"] == versions[1]["_StartDate"]
    assert versions[1]["City"] == "Chennai (new)"
    assert count(dim) == N_CUSTOMERS + 3
    assert count(scd.current_rows(dim, run_on(DAY_2))) == N_CUSTOMERS + 2
    keys = [r[0] for r in dim.select("CustomerSK").orderBy("CustomerSK").collect()]
    assert keys == list(range(1, N_CUSTOMERS + 4))


def test_closed_versions_are_written_once(world):
    lake, _, second = world
    written = by_name(second)[GOLD, "customer_dim"].records_written
    assert written == N_CUSTOMERS + 3  # current rows and the one closed that day
    assert count(lake.read(GOLD, "customer_dim").where("_VersionState = 'closed'")) == 1


def test_fact_keeps_every_order_once(world):
    lake, *_ = world
    fact = lake.read(GOLD, "fact_sales")
    assert count(fact) == N_ORDERS == count(fact.select("OrderID").distinct())
    assert count(fact.where("CustomerSK is null or ProductSK is null")) == 0
    new_key = lake.read(GOLD, "customer_dim").where("CustomerID = 101 and _IsCurrent").first()
    used = fact.where("CustomerID = 101").select("CustomerSK").distinct().collect()
    assert {r[0] for r in used} <= {new_key["CustomerSK"]}


def test_summaries_add_up(world):
    lake, *_ = world
    fact = lake.read(GOLD, "fact_sales").agg(F.sum("TotalAmount"), F.sum("Quantity")).first()
    for name in ("sales_summary", "customer_sales_summary"):
        summary = lake.read(GOLD, name)
        sums = summary.agg(F.sum("TotalSales"), F.sum("TotalQuantity"), F.sum("TotalOrders")).first()
        assert (sums[0], sums[1], sums[2]) == (fact[0], fact[1], N_ORDERS)


def test_audit_log_keeps_every_run(world):
    lake, first, second = world
    assert count(lake.audit_log()) == len(first) + len(second)


def test_batch_cannot_be_committed_twice(world, spark):
    lake, *_ = world
    with pytest.raises(ValueError, match="committed already"):
        lake.write(spark.range(1), BRONZE, "products", run_on(DAY_1))


def test_failed_write_leaves_the_table_as_it_was(world, spark):
    lake, *_ = world
    before = lake.last_commit(GOLD, "sales_summary")
    broken = spark.range(3).select((F.lit(1) / (F.col("id") - 1)).alias("x"), F.raise_error(F.lit("no")))
    run = RunContext("r", "broken", datetime(2024, 5, 3), DAY_2)
    with pytest.raises(Exception):
        lake.write(broken, GOLD, "sales_summary", run)
    assert lake.last_commit(GOLD, "sales_summary") == before
    failed = lake.audit_log().where("status = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0]["error_message"]


def test_layer_tests_and_gates(world):
    lake, *_ = world
    results = {r["test_name"]: r["status"] for r in checks.layer_tests(lake, run_on(DAY_2)).collect()}
    assert set(results.values()) == {"PASS"}
    assert "SCD Current Records" in results and "Watermark" in results
    gates = {r["table_name"]: r for r in checks.gates(lake, run_on(DAY_2)).collect()}
    assert gates["orders"]["state"] == "FRESH" and not gates["orders"]["needs_load"]
    assert gates["customers"]["state"] == "STALE" and gates["customers"]["needs_load"]


def test_empty_lake_reports_absent_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    gates = checks.gates(lake, run_on(DAY_1)).collect()
    assert {g["state"] for g in gates} == {"ABSENT"} and all(g["needs_load"] for g in gates)
    results = checks.layer_tests(lake, run_on(DAY_1)).collect()
    assert {r["status"] for r in results} == {"FAIL"}


def test_publish_writes_enabled_tables_and_counts(world, tmp_path):
    lake, *_ = world

    def to_folder(df, target, options):
        df.write.parquet(f"{options['folder']}/{target}")

    written = publish(lake, {"folder": str(tmp_path)}, to_folder)
    assert written["fact_sales"] == N_ORDERS
    assert written["customer_dim"] == N_CUSTOMERS + 3
    assert set(written) == {p.target_table for p in lake.metadata.published()}


def test_reject_counts(world):
    lake, *_ = world
    found = {r["table_name"]: r["record_count"] for r in checks.reject_counts(lake).collect()}
    assert found["exchange_rates"] == 4 and found["products"] == 0
