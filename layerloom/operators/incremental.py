"""Incremental loading by high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL, INCREMENTAL = "FULL", "INCREMENTAL"


def after_mark(
    df: DataFrame,
    column: str,
    mark: Column | None,
    *,
    inclusive: bool = False,
    undated: bool = False,
) -> DataFrame:
    """Rows past the mark; all rows when there is none yet.

    With ``inclusive`` rows equal to the mark are read again: nothing that
    arrives late with the same timestamp is lost, and keyed tables drop the
    repeats when they keep the latest row per key. ``undated`` keeps the rows
    whose column is NULL.
    """
    if mark is None:
        return df
    wanted = F.col(column) >= mark if inclusive else F.col(column) > mark
    return df.where(wanted | F.col(column).isNull() if undated else wanted)


def load_slice(
    df: DataFrame,
    load_type: str,
    column: str | None,
    mark: Column | None,
    *,
    inclusive: bool = False,
    undated: bool = False,
) -> DataFrame:
    """Everything for a FULL load, rows past the mark for an INCREMENTAL one."""
    if load_type == FULL:
        return df
    if load_type != INCREMENTAL:
        raise ValueError(f"unknown load type {load_type!r}")
    if not column:
        raise ValueError("an incremental load needs a watermark column")
    return after_mark(df, column, mark, inclusive=inclusive, undated=undated)


def next_mark(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows loaded and the new mark, which stays as it was for an empty batch."""
    loaded = after_mark(df, column, mark)
    previous = F.lit(None) if mark is None else mark
    return loaded.agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.coalesce(F.max(column), previous).alias("new_mark"),
    )
