"""Token ids in compressed files: static range asymmetric numeral system, in independent blocks.

A folder holds two Parquet tables. ``table`` has the shared frequencies of the
ids, scaled to a power of two. ``blocks`` has a row per block: the ids of its
documents, its first document's place, its number of ids, and the payload.

A payload is little-endian: the header (``_HEADER``), the number of ids of each
document (u32), the checkpoints (u32 word offset and a u64 state per lane), and
the words (u32) in the order of decoding. Ids are dealt to lanes in turn, and
all lanes step together. At a checkpoint decoding can start afresh, so the
pieces between checkpoints can be decoded in parallel. The header has a
checksum of the ids and one of the rest of the payload.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerloom.llm.rows import ROW, running_total, with_row_key, wrapped
from layerloom.llm.tokens import encoder
from layerloom.storage import staged

MAGIC = b"LRNS"
VERSION = 1
LANES = 1024
#: Steps of all lanes between checkpoints, and ids from which a block is closed after its document.
EVERY = 128
BLOCK_IDS = 1 << 19

# magic, version, scale bits, lanes, steps between checkpoints, documents, ids, words, checksum of ids, checksum of the rest
_HEADER = struct.Struct("<4sHHIIIQQII")
_LOW = np.uint64(1 << 31)  # states lie in 2**31 .. 2**63
_WORD = np.uint64(32)
_MIN_BITS = 18


@dataclass(frozen=True)
class Frequencies:
    """Shared table: ids, their frequencies out of ``1 << bits``, and where each begins."""

    bits: int
    frequency: np.ndarray  # by id
    begin: np.ndarray  # by id

    @classmethod
    def of(cls, frequency: np.ndarray) -> Frequencies:
        total = int(frequency.sum())
        if total & (total - 1) or total == 0:
            raise ValueError("frequencies must add up to a power of two")
        begin = np.cumsum(frequency) - frequency
        return cls(total.bit_length() - 1, frequency.astype(np.uint64), begin.astype(np.uint64))

    def symbols(self) -> np.ndarray:
        """The id of every slot."""
        return np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies in proportion to the counts, at least 1 where there is a count, adding up to a power of two."""
    seen = np.flatnonzero(counts)
    if not len(seen):
        return np.ones(1, np.int64)
    bits = max(_MIN_BITS, int(len(seen)).bit_length() + 2)
    out = np.zeros(len(counts), np.int64)
    share = counts[seen].astype(float) / float(counts[seen].sum())
    out[seen] = np.maximum(np.floor(share * (1 << bits)), 1).astype(np.int64)
    order = seen[np.argsort(-out[seen], kind="stable")]
    surplus = int(out.sum()) - (1 << bits)
    if surplus <= 0:
        out[order[0]] -= surplus
    while surplus > 0:  # the ids with a frequency of 1 had too little; the frequent ones give way
        give = np.minimum(out[order] - 1, np.maximum(out[order] * surplus // (1 << bits), 1))
        give = np.minimum(give, np.maximum(surplus - (np.cumsum(give) - give), 0))
        out[order] -= give
        surplus -= int(give.sum())
    return out


def encode_block(lengths: list[int], ids: np.ndarray, table: Frequencies, lanes: int = LANES, every: int = EVERY) -> bytes:
    """Payload of one block."""
    if len(ids) and (ids.max() >= len(table.frequency) or not table.frequency[ids].all()):
        raise ValueError("an id is not in the frequency table")
    steps = -(-len(ids) // lanes)
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, _LOW, np.uint64)
    chunks: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    emitted = 0
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes : (step + 1) * lanes]
        f, x = table.frequency[part], state[: len(part)]
        full = x >= (f << room)
        words = x[full].astype(np.uint32)
        chunks.append(words)
        emitted += len(words)
        x = np.where(full, x >> _WORD, x)
        quotient = x // f
        state[: len(part)] = (quotient << bits) + (x - quotient * f) + table.begin[part]
        if step % every == 0:
            marks.append((emitted, state.copy()))
    points = b"".join(
        struct.pack("<I", emitted - after) + s.astype("<u8").tobytes() for after, s in reversed(marks)
    )
    stream = np.concatenate(chunks[::-1]).astype("<u4").tobytes() if chunks else b""
    body = np.array(lengths, "<u4").tobytes() + points + stream
    header = _HEADER.pack(
        MAGIC, VERSION, table.bits, lanes, every, len(lengths), len(ids), emitted,
        zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body),
    )
    return header + body


@dataclass(frozen=True)
class Block:
    """A payload taken apart, ready to decode from any checkpoint."""

    lanes: int
    every: int
    n: int
    checksum: int
    lengths: np.ndarray
    offsets: np.ndarray
    states: np.ndarray
    words: np.ndarray

    @classmethod
    def parse(cls, payload: bytes, table: Frequencies) -> Block:
        if len(payload) < _HEADER.size:
            raise ValueError("a block is cut short")
        magic, version, bits, lanes, every, docs, n, words, ids_sum, body_sum = _HEADER.unpack_from(payload)
        if (magic, version, bits) != (MAGIC, VERSION, table.bits):
            raise ValueError("not a block of this format and table")
        if zlib.crc32(payload[_HEADER.size :]) != body_sum:
            raise ValueError("a block is damaged")
        at = _HEADER.size
        lengths = np.frombuffer(payload, "<u4", docs, at)
        at += 4 * docs
        points = -(-(-(-n // lanes)) // every)
        kind = np.dtype([("offset", "<u4"), ("state", "<u8", (lanes,))])
        marks = np.frombuffer(payload, kind, points, at)
        stream = np.frombuffer(payload, "<u4", words, at + points * kind.itemsize)
        return cls(lanes, every, n, ids_sum, lengths, marks["offset"], marks["state"], stream)

    def decode_from(self, point: int, table: Frequencies, symbols: np.ndarray) -> np.ndarray:
        """The ids from one checkpoint to the next."""
        first = point * self.every * self.lanes
        out = np.empty(min(self.n - first, self.every * self.lanes), np.uint32)
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        state, at = self.states[point].astype(np.uint64), int(self.offsets[point])
        for i in range(0, len(out), self.lanes):
            x = state[: min(self.lanes, len(out) - i)]
            slot = x & mask
            found = symbols[slot]
            out[i : i + len(x)] = found
            x = table.frequency[found] * (x >> bits) + slot - table.begin[found]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << _WORD) | self.words[at : at + len(low)]
            at += len(low)
            state[: len(x)] = x
        return out

    def decode(self, table: Frequencies, symbols: np.ndarray) -> np.ndarray:
        parts = [self.decode_from(p, table, symbols) for p in range(len(self.offsets))]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != self.checksum:
            raise ValueError("a block's ids do not match their checksum")
        return ids


def _tokenize(path: str, end: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        close = np.array([end], enc.dtype).tobytes()
        for batch in batches:
            ids = [x + close for x in enc.encode(batch.column("text"))]
            kept = [batch.column(c) for c in ("row", "id", "part")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], names=["row", "id", "part", "ids"])

    return kernel


def _count(dtype: np.dtype, size: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                counts += np.bincount(np.frombuffer(ids.as_py(), dtype), minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["symbol", "n"])

    return kernel


def _encode(dtype: np.dtype, frequency: np.ndarray, kind: pa.DataType):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies.of(frequency)
        rows: list[tuple[int, object, np.ndarray]] = []
        part, size = None, 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x for _, _, x in rows])
            payload = encode_block([len(x) for _, _, x in rows], ids, table)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[0][0]], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([[i for _, i, _ in rows]], pa.list_(kind)),
                    pa.array([payload], pa.binary()),
                ],
                names=["first", "n", "ids", "payload"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "id", "part")]
            for row, i, of, ids in zip(*columns, batch.column("ids")):
                # Rows of one part follow each other; parts read by one task need not.
                if rows and (of != part or size >= BLOCK_IDS):
                    yield block()
                    rows, size = [], 0
                rows.append((row, i, np.frombuffer(ids.as_py(), dtype)))
                part, size = of, size + len(rows[-1][2])
        if rows:
            yield block()

    return kernel


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    end: int = 1,
) -> None:
    """Tokenize documents, close each with the id ``end`` and write them to ``path`` in the order of their ids.

    Documents are sorted by range, tokenized and written down once; the counts
    of all ids, at most one per entry of the vocabulary, make the shared table.

    - NULL and empty texts are one id, ``end``.
    - Rows that share an id come in the order of their texts; rows without an id come last.
    - An empty table makes a folder without blocks; further columns are ignored.
    """
    enc = encoder(tokenizer)
    keyed = with_row_key(wrapped(docs, id_col, text_col).select("id", "text"), "id", ["text"])
    kind = dict(keyed.dtypes)["id"]
    placed = (
        keyed.select(F.col(ROW).alias("row"), "id", "text")
        .repartitionByRange("row")
        .sortWithinPartitions("row")
        .withColumn("part", F.spark_partition_id())
    )
    ids = staged(
        placed.mapInArrow(_tokenize(tokenizer, end), f"row bigint, id {kind}, part int, ids binary"),
        "ids",
        compression="zstd",
    )
    counts = ids.select("ids").mapInArrow(_count(enc.dtype, enc.size), "symbol bigint, n bigint")
    total = np.zeros(enc.size, np.int64)
    for r in counts.groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        total[r.symbol] = r.n
    frequency = scaled(total)
    spark = docs.sparkSession
    table = [(int(s), int(frequency[s])) for s in np.flatnonzero(frequency)]
    spark.createDataFrame(table, "symbol bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/table")
    arrow = to_arrow_type(ids.schema["id"].dataType)
    blocks = ids.mapInArrow(
        _encode(enc.dtype, frequency, arrow), f"first bigint, n bigint, ids array<{kind}>, payload binary"
    )
    blocks.write.parquet(f"{path}/blocks")


def _decode(frequency: np.ndarray, kind: pa.DataType):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Frequencies.of(frequency)
        symbols = table.symbols()
        for batch in batches:
            columns = [batch.column(c) for c in ("before", "ids", "payload")]
            for before, doc_ids, payload in zip(*columns):
                block = Block.parse(payload.as_py(), table)
                ids = block.decode(table, symbols).astype("<u4")
                stops = np.cumsum(block.lengths.astype(np.int64))
                starts = stops - block.lengths
                parts = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids.as_py(), kind),
                        pa.array(starts + before.as_py()),
                        pa.array(block.lengths.astype(np.int64)),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return kernel


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document of a folder; ids are little-endian u32.

    ``start`` counts the ids of all documents before. Blocks are decoded on their
    own; a damaged block is an error.
    """
    rows = spark.read.parquet(f"{path}/table").collect()  # at most one row per id of the vocabulary
    frequency = np.zeros(max((r.symbol for r in rows), default=0) + 1, np.int64)
    for r in rows:
        frequency[r.symbol] = r.frequency
    blocks = spark.read.parquet(f"{path}/blocks")
    places = running_total(blocks.select("first", "n"), [], ["first"], "n", "before").select("first", "before")
    kind = dict(blocks.dtypes)["ids"][len("array<") : -1]
    arrow = to_arrow_type(blocks.schema["ids"].dataType.elementType)
    placed = blocks.join(places, "first").select("before", "ids", "payload")
    schema = f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    return placed.mapInArrow(_decode(frequency, arrow), schema)
