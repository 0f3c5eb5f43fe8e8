"""Copy gold tables to a database."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from layerloom.plans.gold import gold_table
from layerloom.plans.lake import Lake

Writer = Callable[[DataFrame, str, Mapping[str, str]], None]


def publish(
    lake: Lake, options: Mapping[str, str], writer: Writer
) -> dict[str, int]:
    """Replace the target of every enabled table; rows written per target.

    The writer of a database is ``partial(write_table, connections=...)``. Rows are counted while they are written.
    """
    written = {}
    for row in lake.metadata.published():
        counted = Observation()
        df = gold_table(lake, row.table_name).observe(counted, F.count(F.lit(1)).alias("rows"))
        writer(df, row.target_table, options)
        written[row.target_table] = counted.get["rows"]
    return written
