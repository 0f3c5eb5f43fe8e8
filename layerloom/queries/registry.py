"""Named queries over the test tables, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from layerloom.context import RunContext

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; files are listed and their schema read once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_at(day: date, batch: str) -> RunContext:
    """A run with a fixed clock, so that queries repeat exactly."""
    return RunContext(
        run_id="MANUAL_RUN",
        batch_id=batch,
        run_ts=datetime(day.year, day.month, day.day),
        as_of=day,
    )
