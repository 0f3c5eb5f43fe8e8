"""The version that holds at a time, for keys of any number of rows and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.storage import staged


def with_version_as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    when: str,
    value: str,
    *,
    begins: str,
    ends: str,
    first_holds_before: bool = False,
) -> DataFrame:
    """Add ``value`` of the version with ``begins <= when < ends``; NULL ends stay open.

    Versions of a key must not overlap. Rows and versions are sorted together by
    key and time, and every row takes the last version before it: within its
    sort partition by a scan, else from the last partition that holds a version
    of its key. So no row meets more than one version, and a key with a third of
    all rows, or with thousands of versions, spreads over as many partitions as
    it fills. What crosses partitions is one version per key and partition.

    With ``first_holds_before`` the first version of a key holds for earlier
    times too. Rows with a NULL key have no version; rows with a NULL time have
    the first one, if that holds before and is open. A version that ends when it
    begins never holds.
    """
    # A NULL beginning sorts first, so it holds for all earlier rows.
    start = F.col(begins)
    held = versions.where(F.col(key).isNotNull() & (F.col(ends).isNull() | (start < F.col(ends)) | start.isNull()))
    if first_holds_before:
        firsts = held.groupBy(key).agg(F.min(begins).alias("__first"))
        held = held.join(firsts, key).withColumn(begins, F.when(start > F.col("__first"), start))
    kind = rows.schema[when].dataType
    payload = F.struct(F.col(value).alias("value"), F.col(begins).cast(kind).alias("begins"), F.col(ends).cast(kind).alias("ends"))
    marks = held.select(
        F.col(key).alias("__key"), F.col(begins).cast(kind).alias("__at"), F.lit(0).alias("__kind"), payload.alias("__version")
    )
    asked = rows.select(F.col(key).alias("__key"), F.col(when).alias("__at"), F.lit(1).alias("__kind"), F.struct(*[f"`{c}`" for c in rows.columns]).alias("__row"))
    both = marks.withColumn("__row", F.lit(None).cast(asked.schema["__row"].dataType)).unionByName(
        asked.withColumn("__version", F.lit(None).cast(marks.schema["__version"].dataType))
    )
    order = ["__key", "__at", "__kind"]
    placed = staged(
        both.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()), "as-of"
    )
    # The last version of each key in each partition, for the partitions after it.
    lasts = placed.where("__kind = 0").groupBy("__key", "__part").agg(
        F.max_by("__version", F.struct("__at")).alias("__last")
    )
    ends_of = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n")).join(lasts, ["__key", "__part"], "left")
    carried = parts.select("__key", "__part", F.last("__last", ignorenulls=True).over(ends_of).alias("__carried"))
    within = Window.partitionBy("__key", "__part").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.withColumn("__own", F.last("__version", ignorenulls=True).over(within)).where("__kind = 1")
    found = seen.join(carried, ["__key", "__part"], "left").withColumn("__found", F.coalesce("__own", "__carried"))
    version, at = F.col("__found"), F.col("__at")
    holds = (version["begins"].isNull() | (at >= version["begins"])) & (version["ends"].isNull() | (at < version["ends"]))
    return staged(found.select("__row.*", F.when(holds, version["value"]).alias(value)), "as-of")
