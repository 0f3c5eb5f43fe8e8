"""Database source and sink. Connection settings come from the caller only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to read one table with several connections: ranges of a column."""

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


#: For tables known to be small: the whole table through one connection.
ONE_CONNECTION = None


def read_table(
    spark: SparkSession, table: str, options: Mapping[str, str], split: Split | None
) -> DataFrame:
    """Read a table. Filters and column choice reach the database.

    Rows outside the bounds of the split are read too, by the end parts.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if split is not ONE_CONNECTION:
        reader = reader.options(**split.options())
    return reader.load()


def write_table(
    df: DataFrame, table: str, options: Mapping[str, str], *, connections: int
) -> None:
    """Replace the rows of a table, keeping its definition, indexes and grants.

    ``connections`` is what the database bears at a time.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("truncate", True)
        .option("numPartitions", connections)
        .mode("overwrite")
        .save()
    )
