"""Slowly changing dimensions of type 1 and type 2.

A versioned dimension has one current row per business key and any number of
closed ones. A merge compares keys and hashes only, writes down the few keys
that changed, and then passes over the wide rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.operators.keys import dense_key, keep_latest
from layerloom.storage import staged

NEW, CHANGED, SAME, MISSING = "NEW", "CHANGED", "SAME", "MISSING"


def current_rows(dimension: DataFrame, run: RunContext) -> DataFrame:
    return dimension.where(run.columns.is_current)


def _opened(df: DataFrame, run: RunContext) -> DataFrame:
    names = run.columns
    return df.withColumns(
        {
            names.start_date: run.timestamp(),
            names.end_date: F.lit(None).cast("timestamp"),
            names.is_current: F.lit(True),
        }
    )


def initial_versions(
    source: DataFrame, key: str, run: RunContext, *, surrogate: str | None = None
) -> DataFrame:
    """First load: every row is current, keys are numbered in key order."""
    surrogate = surrogate or run.columns.surrogate_key
    return dense_key(_opened(source, run), [key], surrogate)


def classify(
    dimension: DataFrame,
    source: DataFrame,
    key: str,
    run: RunContext,
    *,
    hash_column: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(key, change) for every key in the current dimension or the source.

    Only key and hash are read and shuffled, and the columns of the current
    version in ``carry``. Hashes are compared null-safely.
    """
    h = hash_column or run.columns.record_hash
    before = current_rows(dimension, run).select(
        key, F.col(h).alias("hash_before"), F.lit(True).alias("in_dimension"), *carry
    )
    after = source.select(key, F.col(h).alias("hash_after"), F.lit(True).alias("in_source"))
    change = (
        F.when(F.col("in_dimension").isNull(), NEW)
        .when(F.col("in_source").isNull(), MISSING)
        .when(F.col("hash_before").eqNullSafe(F.col("hash_after")), SAME)
        .otherwise(CHANGED)
    )
    return before.join(after, key, "full_outer").select(key, change.alias("change"), *carry)


def new_rows(dimension: DataFrame, source: DataFrame, key: str, run: RunContext) -> DataFrame:
    """Source rows whose key has no current version."""
    return source.join(current_rows(dimension, run).select(key), key, "left_anti")


def changed_rows(
    dimension: DataFrame, source: DataFrame, key: str, run: RunContext, *, hash_column: str | None = None
) -> DataFrame:
    """Source rows whose current version has another hash."""
    h = hash_column or run.columns.record_hash
    before = current_rows(dimension, run).select(key, F.col(h).alias("__hash_before"))
    return (
        source.join(before, key, "inner")
        .where(~F.col(h).eqNullSafe(F.col("__hash_before")))
        .drop("__hash_before")
    )


def latest_versions(
    dimension: DataFrame, source: DataFrame, key: str, run: RunContext, *, hash_column: str | None = None
) -> DataFrame:
    """New and changed source rows, opened as of this run."""
    added = new_rows(dimension, source, key, run)
    changed = changed_rows(dimension, source, key, run, hash_column=hash_column)
    return _opened(added.unionByName(changed, allowMissingColumns=True), run)


def highest_key(dimension: DataFrame, surrogate: str) -> int:
    return dimension.agg(F.max(surrogate).alias("top")).first()["top"] or 0


def find_changes(
    current: DataFrame,
    source: DataFrame,
    key: str,
    run: RunContext,
    *,
    surrogate: str | None = None,
    hash_column: str | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """(key, change, surrogate key of the current version) of all keys that a load
    opens or closes a version of, written down."""
    surrogate = surrogate or run.columns.surrogate_key
    wanted = [NEW, CHANGED, MISSING] if close_missing else [NEW, CHANGED]
    found = classify(current, source, key, run, hash_column=hash_column, carry=[surrogate])
    return staged(found.where(F.col("change").isin(wanted)), "scd-changes")


def opening() -> Column:
    """Changes that open a version; the others, and changed keys, close one."""
    return F.col("change").isin(NEW, CHANGED)


def closing() -> Column:
    return F.col("change").isin(CHANGED, MISSING)


def apply_changes(
    current: DataFrame,
    source: DataFrame,
    changes: DataFrame,
    key: str,
    run: RunContext,
    *,
    highest: int,
    surrogate: str | None = None,
) -> DataFrame:
    """Close and open the versions that ``changes`` names; other rows of ``current`` stay.

    ``current`` may be a part of the current versions that holds all those to be closed.
    """
    names = run.columns
    surrogate = surrogate or names.surrogate_key
    numbered = dense_key(
        changes.where(opening()).select(key),
        [key],
        surrogate,
        start=highest,
        key_type=current.schema[surrogate].dataType.simpleString(),
    )
    closed_keys = changes.where(closing()).select(key, F.lit(True).alias("__closing"))
    is_closing = F.col("__closing").isNotNull()
    survivors = (
        current.join(closed_keys, key, "left")
        .withColumns(
            {
                names.end_date: F.when(is_closing, run.timestamp()).otherwise(
                    F.col(names.end_date)
                ),
                names.is_current: ~is_closing,
            }
        )
        .select(*current.columns)
    )
    opened = _opened(source.join(numbered, key, "inner"), run)
    return survivors.unionByName(opened, allowMissingColumns=True)


def merge_versions(
    dimension: DataFrame,
    source: DataFrame,
    key: str,
    run: RunContext,
    *,
    surrogate: str | None = None,
    hash_column: str | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """Dimension after a load: history, closed, unchanged and new versions.

    Rows closed by earlier runs are passed through untouched. Keys absent from
    the source stay current unless ``close_missing``. The source must hold one
    row per key (see ``keep_latest``) and no NULL key. Columns that exist on one
    side only are kept and filled with NULL.
    """
    surrogate = surrogate or run.columns.surrogate_key
    current = current_rows(dimension, run)
    changes = find_changes(
        current, source, key, run, surrogate=surrogate, hash_column=hash_column, close_missing=close_missing
    )
    highest = highest_key(dimension, surrogate)
    merged = apply_changes(current, source, changes, key, run, highest=highest, surrogate=surrogate)
    history = dimension.where(~F.col(run.columns.is_current))
    return history.unionByName(merged, allowMissingColumns=True)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Type 1: one row per key over target and source, the latest wins."""
    return keep_latest(target.unionByName(source, allowMissingColumns=True), keys, order_by)
