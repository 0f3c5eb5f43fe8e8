"""The silver layer: typed, validated rows, with the rejected ones beside them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.functions.columns import typed
from layerloom.metadata import TableConfig
from layerloom.operators.incremental import INCREMENTAL
from layerloom.operators.keys import keep_latest
from layerloom.operators.validate import flag_uncastable, mark
from layerloom.plans.lake import BRONZE, SILVER, AuditRow, Lake

def key_columns(keys: str) -> list[str]:
    return [k.strip() for k in keys.split(",")]


OUTCOME = "_Outcome"
VALID, REJECT = "valid", "reject"


def to_silver(
    lake: Lake,
    bronze: DataFrame,
    config: TableConfig,
    run: RunContext,
    *,
    severity_aware: bool = False,
) -> DataFrame:
    """Bronze rows with declared types, violated rules and rejected flag."""
    types = lake.metadata.types_of(config.table_name)
    raw, rules = flag_uncastable(bronze, lake.metadata.rules_of(config.table_name), types)
    return mark(typed(raw, types), rules, run, severity_aware=severity_aware)


def load_silver(
    lake: Lake,
    config: TableConfig,
    run: RunContext,
    *,
    severity_aware: bool = False,
    bronze_batch: str | None = None,
) -> AuditRow:
    """Validate one bronze batch, by default the last, and write both outcomes in one pass.

    Only valid rows move the mark: a rejected row with a date far ahead must
    not make later loads skip everything.
    """
    if bronze_batch is None:
        bronze = lake.read(BRONZE, config.table_name)
    else:
        bronze = lake.read_batch(BRONZE, config.table_name, bronze_batch)
    rows = to_silver(lake, bronze, config, run, severity_aware=severity_aware)
    rejected = F.col(run.columns.is_rejected)
    wm = config.watermark_column
    return lake.write(
        rows.withColumn(OUTCOME, F.when(rejected, REJECT).otherwise(VALID)),
        SILVER,
        config.table_name,
        run,
        table_format=config.target_file_format,
        partition_by=[OUTCOME],
        rejected=rejected,
        watermark=F.when(~rejected, F.col(wm)) if wm and wm in rows.columns else None,
    )


def _outcome(rows: DataFrame, outcome: str) -> DataFrame:
    return rows.where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def valid_rows(
    lake: Lake, config: TableConfig, run: RunContext, *, since: datetime | None = None
) -> DataFrame | None:
    """Valid rows, one per primary key for incremental tables.

    A full table is its last batch. An incremental one is the latest row per
    key over all batches, or over those committed after ``since``.
    """
    names = run.columns
    if config.load_type == INCREMENTAL:
        rows = lake.read_batches(SILVER, config.table_name, since)
    else:
        rows = lake.read_or_none(SILVER, config.table_name)
    if rows is None:
        return None
    rows = _outcome(rows, VALID).drop(names.failed_rules)
    order = [config.watermark_column] if config.watermark_column in rows.columns else []
    # Few batches hold the same key.
    return keep_latest(
        rows, key_columns(config.primary_key), [*order, names.processed_at, names.record_hash], few=True
    )


def rejected_rows(lake: Lake, config: TableConfig) -> DataFrame | None:
    """Rejected rows of all batches, with the rules they violated."""
    rows = lake.read_batches(SILVER, config.table_name)
    return None if rows is None else _outcome(rows, REJECT)
