"""Nearest neighbours by cosine with a hash-prefix forest."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.rows import ROW, with_row_key
from layerloom.storage import staged

BITS = 64  # length of a hash string
TREES = 32
#: Share of a shard's rows that a query looks at before it stops climbing.
PROBED = 0.5
#: Most rows of a shard and most queries of a block: what one task holds.
SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
_SEED = 11


class Forest:
    """Trees of sorted hash strings over some vectors.

    Each bit of a string is the side of a random plane, so vectors at a small
    angle share long prefixes. A tree is the sorted array of its strings: the
    rows below a node are a range of it.
    """

    def __init__(self, vectors: np.ndarray, trees: int = TREES):
        self.vectors = vectors
        rng = np.random.default_rng(_SEED)
        self._planes = [rng.standard_normal((vectors.shape[1], BITS)) for _ in range(trees)]
        self._order, self._sorted = [], []
        for planes in self._planes:
            strings = self._strings(vectors, planes)
            order = np.argsort(strings, kind="stable")
            self._order.append(order)
            self._sorted.append(strings[order])
        # Prefixes far longer than this tell no more rows apart, unless rows are copies.
        self._depth = min(BITS, max(len(vectors), 1).bit_length() + 8)

    @staticmethod
    def _strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
        bits = (vectors @ planes > 0).astype(np.uint8)
        return np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64)

    def candidates(self, queries: np.ndarray, wanted: int):
        """Rows near each query: at least ``wanted``, or all there are.

        Descend to the longest prefix that any row shares with the query, then
        climb in all trees at once, a bit at a time, and gather what lies below,
        until enough different rows are found.
        """
        depths = np.arange(self._depth + 1)
        low = np.empty((len(queries), len(self._planes), len(depths)), np.int32)
        high = np.empty_like(low)
        for t, planes in enumerate(self._planes):
            strings = self._strings(queries, planes)
            for d in depths.tolist():
                rest = np.uint64((1 << (BITS - d)) - 1)  # what a prefix of d bits leaves open
                low[:, t, d] = np.searchsorted(self._sorted[t], strings & ~rest, "left")
                high[:, t, d] = np.searchsorted(self._sorted[t], strings | rest, "right")
        below = (high - low).sum(axis=1)  # of each query and depth, with repeats
        for q in range(len(queries)):
            # Depths with too few rows even if no row is met twice can be passed at once.
            d = int(np.flatnonzero(below[q] >= min(wanted, len(self.vectors)))[-1])
            found = np.zeros(len(self.vectors), bool)
            while True:
                for t, order in enumerate(self._order):
                    found[order[low[q, t, d] : high[q, t, d]]] = True
                if d == 0 or np.count_nonzero(found) >= wanted:
                    break
                d -= 1
            yield np.flatnonzero(found)


def _nearest(rows: pd.DataFrame, queries: pd.DataFrame, k: int, probed: float, trees: int) -> pd.DataFrame:
    """The k nearest rows of a shard for each query of a block."""
    out: list[tuple[int, int, float]] = []
    if len(rows) and len(queries):
        x, y = (np.stack(f["vector"].to_numpy()).astype(np.float64) for f in (rows, queries))
        ids, query_ids = rows["id"].to_numpy(), queries["id"].to_numpy()
        own, query_own = rows["row"].to_numpy(), queries["row"].to_numpy()
        x, y = _scaled(x), _scaled(y)
        lengths, query_lengths = (np.sqrt((v * v).sum(axis=1)) for v in (x, y))
        unit = x / lengths[:, None]
        forest = Forest(unit, trees)
        wanted = max(math.ceil(probed * len(rows)), 4 * k)
        for q, found in enumerate(forest.candidates(y / query_lengths[:, None], wanted)):
            found = found[own[found] != query_own[q]]
            rough = unit[found] @ (y[q] / query_lengths[q])
            if len(found) > k:
                # A margin above rounding keeps all that may tie.
                found = found[rough >= np.partition(rough, -k)[-k] - 1e-9]
            # Row by row, so that equal vectors get equal scores wherever they lie.
            scores = (x[found] * y[q]).sum(axis=1) / (lengths[found] * query_lengths[q])
            best = found[np.lexsort((own[found], ids[found], -scores))[:k]]
            of = dict(zip(found.tolist(), scores.tolist()))
            out += [(query_own[q], query_ids[q], own[i], ids[i], of[i]) for i in best.tolist()]
    return pd.DataFrame(out, columns=["query", "query_id", "row", "vec_id", "score"]).astype(
        {"query": "int64", "query_id": "int64", "row": "int64", "vec_id": "int64", "score": "float64"}
    )


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors whose squares would leave the range of doubles, times a power of two; others as they are."""
    largest = np.abs(vectors).max(axis=1)
    power = np.where((largest > 1e100) | (largest < 1e-100), np.frexp(largest)[1], 0)
    return np.ldexp(vectors, -power[:, None])


def _usable(vector: Column) -> Column:
    """Whether a vector has a direction: no NULL, NaN or infinite component, and not all zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    k: int = 5,
    probed: float = PROBED,
    trees: int = TREES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k nearest rows found, by cosine.

    Rows are dealt to shards by a hash of their id and queries to blocks; every
    block meets every shard in a task of bounded size, where a forest over the
    shard picks the candidates and the cosine of the original vectors, in
    double precision, ranks them. The best k of all shards remain; equal scores
    are ranked by id.

    ``probed`` sets recall against work. Vectors without structure need a large
    share of all rows for a high recall, whatever the index.

    - Rows with a NULL id, and vectors that are NULL, empty, zero or hold a NULL,
      NaN or infinite component, take no part.
    - Rows that share an id are rows of their own: each is a candidate, also for the others, and each asks.
    - ``is_query`` may use any column of the table; vectors of another dimension
      than a query's are not compared with it.
    - An empty table, or one without queries, gives an empty result.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    rows = with_row_key(rows, "id", ["vector", "asks"]).withColumnRenamed(ROW, "row")
    rows = staged(rows.withColumn("size", F.size("vector")), "vectors")
    sizes = rows.groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked")
    )
    shards = F.ceil(F.col("n") / SHARD_ROWS).cast("int")
    blocks = F.ceil(F.col("asked") / QUERY_ROWS).cast("int")
    plan = sizes.filter("asked > 0").select("size", shards.alias("shards"), blocks.alias("blocks"))
    placed = rows.join(plan, "size").withColumn("place", F.xxhash64("row"))
    own_shard, own_block = F.pmod("place", "shards"), F.pmod("place", "blocks")
    by_shard = placed.withColumn("shard", own_shard.cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    by_block = (
        placed.filter("asks")
        .withColumn("block", own_block.cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    )
    key = ["size", "shard", "block"]
    met = by_shard.select(*key, "row", "id", "vector", F.lit(False).alias("asks")).union(
        by_block.select(*key, "row", "id", "vector", F.lit(True).alias("asks"))
    )
    # Cells are few and heavy, so they are dealt out whatever their size in bytes.
    cells = plan.agg(F.sum(F.col("shards").cast("long") * F.col("blocks"))).first()[0] or 1
    found = met.repartition(2 * cells, *key).groupBy(*key).applyInPandas(
        lambda rows: _nearest(rows[~rows["asks"]], rows[rows["asks"]], k, probed, trees),
        "query bigint, query_id bigint, row bigint, vec_id bigint, score double",
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
