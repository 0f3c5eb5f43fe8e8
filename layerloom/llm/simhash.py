"""Near-duplicate documents by SimHash fingerprints and pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.components import connected_components
from layerloom.llm.rows import ROW, with_row_key, wrapped
from layerloom.llm.words import lower_ascii
from layerloom.storage import staged

BITS = 64
SEGMENTS = 8
WIDTH = BITS // SEGMENTS
SEED = 42
_CHUNK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text; 0 if it has no word."""
    words = lower_ascii(text).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    last = max(len(words) - shingle + 1, 1)
    starts = (ends - sizes)[:last].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, last, _CHUNK):
        h = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + _CHUNK], stops[i : i + _CHUNK])],
            "<u8",
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, fingerprint) of every document, the fingerprint as a signed long."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["id", "fingerprint"]
            )

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = dict(texts.dtypes)["id"]
    return texts.mapInArrow(kernel, f"id {kind}, fingerprint bigint")


def _budget(length: int, distance: int) -> int:
    """Differences that a chain of segments may hold in total."""
    return length * distance // SEGMENTS


def _segments(start: int, length: int) -> int:
    """Mask of consecutive segments on the ring, as a signed long."""
    mask = 0
    for i in range(start, start + length):
        mask |= ((1 << WIDTH) - 1) << (WIDTH * (i % SEGMENTS))
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keys(distance: int) -> list[tuple[int, int]]:
    """(chain start, mask) of the bits that must agree for a pair to be looked at.

    Around the ring of a pair within the distance there is a start from which
    every chain keeps its budget. The longest chain with budget 0 agrees
    wholly; of the segments up to the longest chain with budget 1 at most one
    differs. One key per start and per segment that may differ finds all pairs.
    """
    equal = max(n for n in range(SEGMENTS + 1) if _budget(n, distance) == 0)
    almost = max(n for n in range(SEGMENTS + 1) if _budget(n, distance) <= 1)
    if equal == SEGMENTS:
        return [(0, -1)]
    keys = []
    for start in range(SEGMENTS):
        for skipped in range(equal, almost):
            mask = _segments(start, almost) & ~_segments(start + skipped, 1)
            keys.append((start, mask))
    return keys


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b), a < b: pairs of different fingerprints that differ in at most ``distance`` bits.

    ``prints`` has one column of distinct fingerprints. Pairs are sought by
    pigeonring: chains of consecutive 8-bit segments must keep budgets in
    proportion to their length. The shortest chains are the join key, the
    others are checked before the whole Hamming distance.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError(f"distance must be 0 to {SEGMENTS - 1}")
    name = prints.columns[0]
    keys = F.array(
        *[
            F.struct(
                F.lit(i).alias("k"),
                F.col(name).bitwiseAND(F.lit(mask)).alias("part"),
                F.lit(start).alias("start"),
            )
            for i, (start, mask) in enumerate(_keys(distance))
        ]
    )
    indexed = prints.select(F.col(name).alias("f"), F.explode(keys).alias("key")).select("f", "key.*")
    a, b = indexed.alias("a"), indexed.alias("b")
    apart = F.col("a.f").bitwiseXOR(F.col("b.f"))
    near = F.bit_count(apart) <= distance
    same = (F.col("a.k") == F.col("b.k")) & (F.col("a.part") == F.col("b.part"))
    chains = _chains_hold(apart, F.col("a.start"), distance)
    pairs = a.join(b, same & (F.col("a.f") < F.col("b.f")) & chains & near)
    return pairs.select(F.col("a.f").alias("a"), F.col("b.f").alias("b")).distinct()


def _chains_hold(apart: Column, start: Column, distance: int) -> Column:
    """Whether every chain from the start keeps its budget."""
    holds = F.lit(True)
    for n in range(1, SEGMENTS):
        masks = F.array(*[F.lit(_segments(s, n)) for s in range(SEGMENTS)])
        holds = holds & (F.bit_count(apart.bitwiseAND(F.get(masks, start))) <= _budget(n, distance))
    return holds


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 3,
    distance: int = 3,
) -> DataFrame:
    """(id, fingerprint, component) of every document.

    Documents whose fingerprints differ in at most ``distance`` bits are linked;
    the component is the smallest id that can be reached over links. Equal
    fingerprints are one node, so copies are never compared with each other.

    - NULL and empty texts, and texts without a word, have fingerprint 0 and are linked like any other.
    - Texts with fewer words than a shingle are hashed whole.
    - Repeated rows and repeated ids give one result row each.
    - A NULL id gets the component of its group, which is NULL if the group has no other id.
    - An empty table gives an empty result; further columns are ignored.
    """
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("id").alias("first"))
    labels = connected_components(links(nodes.select("fingerprint"), distance))
    linked = nodes.join(labels, F.col("fingerprint") == F.col("node"))
    firsts = linked.groupBy("component").agg(F.min("first").alias("reached"))
    reached = linked.join(firsts, "component").select("fingerprint", "reached")
    # Written down, the last join is a plain one whose frequent fingerprints Spark can split.
    classes = staged(
        nodes.join(reached, "fingerprint", "left").select(
            "fingerprint", F.coalesce("reached", "first").alias("component")
        ),
        "classes",
    )
    return prints.join(classes, "fingerprint").select("id", "fingerprint", "component")


def without_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 3,
    distance: int = 3,
) -> DataFrame:
    """The documents with the smallest id of each group, all columns as they were.

    Of rows that share an id and a group, one stays. Groups of which no row has an id keep one row.
    """
    keyed = with_row_key(wrapped(docs, id_col, text_col), "id", ["text"])
    groups = near_duplicates(keyed, ROW, "text", shingle=shingle, distance=distance)
    kept = groups.filter("id = component").select(F.col("id").alias(ROW))
    return keyed.join(kept, ROW, "left_semi").select("doc.*")
