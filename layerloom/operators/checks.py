"""Table-level checks: freshness gates, row counts and layer assertions."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PASS, FAIL = "PASS", "FAIL"
FRESH, STALE, EMPTY, ABSENT = "FRESH", "STALE", "EMPTY", "ABSENT"


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def freshness(
    spark: SparkSession, tables: Mapping[str, tuple[DataFrame | None, str]], as_of: date
) -> DataFrame:
    """Newest date per table and whether the table needs loading.

    ``tables`` maps a name to (frame, date column); the frame is None when the
    table does not exist. Missing, empty and out-of-date tables need loading.
    """
    frames = []
    for name, (df, column) in tables.items():
        if df is None:
            last, exists = spark.range(1).agg(F.max(F.lit(None).cast("date"))), False
        else:
            last, exists = df.agg(F.max(column).cast("date")), True
        frames.append(
            last.toDF("last_date").select(
                F.lit(name).alias("table_name"), "last_date", F.lit(exists).alias("exists")
            )
        )
    state = (
        F.when(~F.col("exists"), ABSENT)
        .when(F.col("last_date").isNull(), EMPTY)
        .when(F.col("last_date") < F.lit(as_of), STALE)
        .otherwise(FRESH)
    )
    return (
        _stack(frames)
        .withColumn("state", state)
        .withColumn("needs_load", F.col("state") != FRESH)
        .drop("exists")
    )


# The flags handed to the caller and the mode they come with.
GATE_FLAGS = {
    "orders": "ingest_csv",
    "customers": "ingest_customers",
    "exchange_rates": "ingest_exchange_rate",
}
PUBLISH_FLAG = "publish_to_sql"
GENERATION_MODE = "daily_incremental"


def gate_document(gates: DataFrame) -> DataFrame:
    """The gates as one row with a JSON object of "true"/"false" flags.

    Publishing is always on. A table without a gate counts as not loaded.
    """
    def flag(table: str, alias: str) -> Column:
        wanted = F.max(F.when(F.col("table_name") == table, F.col("needs_load")))
        return F.coalesce(wanted, F.lit(True)).cast("string").alias(alias)

    flags = gates.agg(*[flag(t, alias) for t, alias in GATE_FLAGS.items()])
    return flags.select(
        F.to_json(
            F.struct(
                *GATE_FLAGS.values(),
                F.lit("true").alias(PUBLISH_FLAG),
                F.lit(GENERATION_MODE).alias("generation_mode"),
            )
        ).alias("gates")
    )


def row_counts(tables: Mapping[str, DataFrame], layer: str | None = None) -> DataFrame:
    """(layer, table, rows) for every table, in one job."""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("record_count")).select(
                *([F.lit(layer).alias("layer")] if layer else []),
                F.lit(name).alias("table_name"),
                "record_count",
            )
            for name, df in tables.items()
        ]
    )


def layer_assertions(
    spark: SparkSession, tests: Mapping[str, tuple[DataFrame | None, Column | None]]
) -> DataFrame:
    """(test_name, status) for each test, in one job.

    A test is a table and a condition. It passes when some row meets the
    condition (or, without one, when there is any row) and fails when none
    does or the table, given as None, does not exist.
    """
    frames = []
    for name, (df, condition) in tests.items():
        if df is None:
            status = spark.range(1).select(F.lit(FAIL).alias("status"))
        else:
            counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
            status = df.agg(F.when(counted > 0, PASS).otherwise(FAIL).alias("status"))
        frames.append(status.select(F.lit(name).alias("test_name"), "status"))
    return _stack(frames)
