"""Dense surrogate keys and keep-latest, without single-task windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.storage import staged

# monotonically_increasing_id puts the partition number above this many bits.
_POSITION_BITS = 33


def dense_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    *,
    start: int = 0,
    key_type: str = "bigint",
) -> DataFrame:
    """Number the rows ``start + 1 .. start + n`` in the given order.

    Same result as ``row_number() over (order by ...)``, but the sort is a
    distributed one: rows are range-partitioned and written out with their
    partition and position, then every partition is shifted by the rows before
    it. Only the row count per partition reaches the driver. ``order_by`` must
    order the rows fully (a unique key, or a key plus tie-breakers).
    """
    position = f"{name}__position"
    placed = staged(
        df.orderBy(*order_by).withColumn(position, F.monotonically_increasing_id()),
        f"key-{name}",
    )
    block = F.shiftright(position, _POSITION_BITS).cast("int")
    in_block = F.col(position).bitwiseAND((1 << _POSITION_BITS) - 1)

    # One count per sort partition: bounded by the shuffle width.
    sizes = {
        r["block"]: r["n"]
        for r in placed.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    before = [start]
    for i in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(i, 0))
    rows_before = F.get(F.lit(before).cast("array<bigint>"), block)
    return placed.withColumn(name, (rows_before + in_block + 1).cast(key_type)).drop(position)


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], *, few: bool = False
) -> DataFrame:
    """One row per key: the one that sorts last; NULLs sort first.

    Rows with a NULL in a key are no versions of one another and all stay.

    An aggregate rather than a ranking window, so each task reduces its own
    rows before the shuffle and a very frequent key costs one row per task.
    To reduce them a task sorts all that it read. Where keys have few rows each
    (``few``) that saves nothing, and rows are shuffled first: each task then
    sorts one partition, whose size adaptive execution bounds.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    keyless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    numbered = df.withColumn("__alone", F.when(keyless, F.monotonically_increasing_id()))
    if few:
        numbered = numbered.repartition(*keys, "__alone")
    return (
        numbered.groupBy(*keys, "__alone")
        .agg(F.max_by(F.struct(*others), F.struct(*order_by)).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
