"""Freshness gates and layer tests over the tables of a lake."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.operators import checks
from layerloom.plans.gold import FACT_TABLE, SURROGATE_KEYS, gold_table
from layerloom.plans.lake import BRONZE, GOLD, SILVER, Lake
from layerloom.plans.silver import OUTCOME, VALID, rejected_rows


def gates(lake: Lake, run: RunContext, as_of: date | None = None) -> DataFrame:
    """Which sources need loading today."""
    probes = {
        "orders": (BRONZE, run.columns.ingested_at),
        "customers": (SILVER, "LastUpdated"),
        "exchange_rates": (SILVER, "RateDate"),
    }
    tables = {
        name: (lake.read_or_none(layer, name), column) for name, (layer, column) in probes.items()
    }
    return checks.freshness(lake.spark, tables, as_of or run.as_of)


def layer_tests(lake: Lake, run: RunContext) -> DataFrame:
    """PASS or FAIL for each layer, rejects, history, audit log and marks."""
    tests = {}
    for config in lake.metadata.active_tables():
        name = config.table_name
        tests[f"{name} Bronze Exists"] = (lake.read_or_none(BRONZE, name), None)
        tests[f"{name} Silver Exists"] = (
            lake.read_or_none(SILVER, name),
            F.col(OUTCOME) == VALID,
        )
    for name in [*SURROGATE_KEYS, FACT_TABLE]:
        tests[f"{name} Gold Exists"] = (gold_table(lake, name) if lake.exists(GOLD, name) else None, None)
    # The reject table has rows once any batch of any table had a reject.
    log = lake.audit_log()
    tests["Reject Table Exists"] = (log, F.col("records_rejected") > 0)
    tests["SCD Current Records"] = (
        gold_table(lake, "customer_dim") if lake.exists(GOLD, "customer_dim") else None,
        F.col(run.columns.is_current),
    )
    tests["Audit Table"] = (log, None)
    tests["Watermark"] = (log, F.col("watermark").isNotNull())
    return checks.layer_assertions(lake.spark, tests)


def reject_counts(lake: Lake) -> DataFrame:
    """Rejected rows per table in all batches."""
    found = {}
    for config in lake.metadata.active_tables():
        rows = rejected_rows(lake, config)
        if rows is not None:
            found[config.table_name] = rows
    return checks.row_counts(found, "reject")
