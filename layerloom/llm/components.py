"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.storage import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.union(edges.select("v", "u"))
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    larger = both.filter("v > u").join(smallest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(smallest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; the component is its smallest node.

    ``edges`` has two columns of one ordered type without NULLs. Large-star and
    small-star steps alternate until nothing changes; each round is written to
    the shared folder, so no round is recomputed. Only a count and a checksum
    of each round reach the driver. No edges give an empty result.
    """
    a, b = edges.columns
    current = staged(
        edges.filter(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(),
        "edges",
    )
    state = None
    while True:
        current = staged(_small_star(_large_star(current)), "stars")
        # Decimal sums cannot overflow.
        mark = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if mark == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select("v", "v").distinct()
            )
        state = mark
