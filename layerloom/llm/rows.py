"""Row keys and running totals that no single task has to compute."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.operators.keys import dense_key
from layerloom.storage import staged

ROW = "_row"


def wrapped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text): the whole row as ``doc``, so that no column name can clash."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(
        F.struct(*columns).alias("doc"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )


def with_row_key(df: DataFrame, id_col: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Add ``_row``, a unique number that orders rows by id.

    Unique whole-number ids are taken as they are. Otherwise rows are sorted
    (NULL ids last, equal ids by the tie breakers) and numbered; the numbered
    rows are written to the shared folder, so a lost executor cannot renumber them.
    """
    if dict(df.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        repeated = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
        if not repeated.filter((F.col("_n") > 1) | F.col(id_col).isNull()).head(1):
            return df.withColumn(ROW, F.col(id_col).cast("long"))
    missing = df.withColumn("_no_id", F.col(id_col).isNull())
    numbered = dense_key(missing, ["_no_id", id_col, *tie_breakers], ROW, key_type="bigint")
    return numbered.drop("_no_id")


def running_total(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the same keys (0 for the first).

    Rows are range-partitioned by keys and order and written down; each partition
    adds up its own rows, and one total per partition and key is added up across
    partitions. A key that holds a third of the rows spreads over a third of the
    partitions. ``order_by`` must order the rows of a key fully.
    """
    sort = [*keys, *order_by]
    placed = staged(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_part", F.spark_partition_id()),
        f"total-{name}",
    )
    totals = placed.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_part")
    before = totals.select(
        F.col("_part").alias("_of"),
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        _sum_before("_sum", earlier).alias("_before"),
    )
    within = Window.partitionBy("_part", *keys).orderBy(*order_by)
    local = placed.withColumn("_local", _sum_before(value, within))
    same = [F.col("_part") == F.col("_of"), *[F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]]
    joined = local.join(before, reduce(Column.__and__, same))
    total = (F.col("_before") + F.col("_local")).alias(name)
    return joined.select(*[F.col(c) for c in df.columns], total)


def _sum_before(value: str, window) -> Column:
    rows = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0)).cast("long")
