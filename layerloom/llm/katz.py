"""Katz backoff: word bigrams over words, with Good-Turing discounts.

The probability of a token after another is its discounted relative frequency
if the pair was learnt; otherwise it is the backoff weight of the first token
times the probability of the second one alone. Tokens that were not learnt are
one class, so the probabilities after any token add up to 1.

Texts become blocks of some million words, numbered within the block. Blocks
ask for the counts of their distinct tokens and pairs: every part of the key
space adds up what the blocks hand in, stores its slice of the count table and
answers each block in the order of its keys. So each pair crosses the network
once per block, however often it occurs, and a frequent word is one key per
block wherever it stands. Keys are 64-bit hashes.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerloom.llm.words import lower_ascii, mixed, word_hashes
from layerloom.storage import shared_folder, staged

#: Words from which a block is closed after its document.
BLOCK_WORDS = 1 << 21
#: Words of the corpus for each part of the key space, so that what a task holds of one stays the same.
PART_WORDS = 1 << 20
#: Counts above this are taken as they are, without discount.
MOST_DISCOUNTED = 5

_START, _END = np.uint64(1), np.uint64(2)  # keys of what precedes a text and of what closes it
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LEVELS = (1, 2)


def _packed(values: np.ndarray) -> bytes:
    """Compressed numbers, byte planes one after the other."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(raw.T.tobytes())


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<u8"), dtype=np.uint64)


def _edges(parts: int) -> np.ndarray:
    """First key of every part but the first."""
    return np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)


def _slices(keys: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of sorted keys, without empty parts."""
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            yield part, a, b


# Blocks of texts


class _Open:
    """A block that still takes texts; of its words it keeps the distinct ones and a number each."""

    def __init__(self, kind: pa.DataType):
        self.kind = kind
        self.numbers: dict[bytes, int] = {}
        self.flat = array("I")
        self.lengths: list[int] = []
        self.ids: list[object] = []
        self.held: list[bool] = []

    def add(self, i: object, held: bool, text: bytes) -> None:
        words, number = lower_ascii(text).split(), self.numbers.setdefault
        self.flat.extend([number(w, len(self.numbers)) for w in words])
        self.lengths.append(len(words) + 1)
        self.ids.append(i)
        self.held.append(held)

    def size(self) -> int:
        return len(self.flat) + len(self.lengths)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = None
    for batch in batches:
        columns = [batch.column(c) for c in ("id", "held", "text")]
        for i, h, text in zip(*columns):
            block = block or _Open(batch.schema.field("id").type)
            block.add(i.as_py(), h.as_py(), text.as_py() or b"")
            if block.size() >= BLOCK_WORDS:
                yield _closed(block)
                block = None
    if block:
        yield _closed(block)


def _closed(block: _Open) -> pa.RecordBatch:
    ids, held, kind = block.ids, block.held, block.kind
    keys = np.append(word_hashes(list(block.numbers)), [_START, _END])
    keys, place = np.unique(keys, return_inverse=True)
    place = place.astype("<u4")
    lengths = np.array(block.lengths, np.int64)
    tokens = np.full(int(lengths.sum()), place[-1], "<u4")
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(lengths) - 1] = False
    tokens[inner] = place[np.frombuffer(block.flat, np.uint32)]
    # Frequent words get small numbers, which take less room.
    often = np.bincount(tokens, minlength=len(keys)).astype("<u4")
    number = np.empty(len(keys), "<u4")
    number[_by_frequency(often)] = np.arange(len(keys))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids], pa.list_(kind)),
            pa.array([held], pa.list_(pa.bool_())),
            pa.array([lengths.tolist()], pa.list_(pa.int64())),
            pa.array([_packed_keys(keys)], pa.binary()),
            pa.array([_packed(often)], pa.binary()),
            pa.array([_packed(number[tokens])], pa.binary()),
        ],
        names=["ids", "held", "lengths", "words", "often", "tokens"],
    )


def _by_frequency(often: np.ndarray) -> np.ndarray:
    """Places of words, the most frequent first."""
    return np.argsort(-often.astype(np.int64), kind="stable")


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch; they are large, so only one at a time is turned into objects."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class _Texts:
    """A block taken apart: its tokens and pairs as places among its distinct ones."""

    def __init__(self, row: dict):
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.words = _unpacked_keys(row["words"])
        order = _by_frequency(_unpacked(row["often"], "<u4")).astype(np.int32)
        self.tokens = order[_unpacked(row["tokens"], "<u4")]
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[np.cumsum(self.lengths) - self.lengths] = np.searchsorted(self.words, _START)
        keys = self.words[self.before]
        with np.errstate(over="ignore"):
            keys *= _PAIR
            keys += self.words[self.tokens]
            keys = mixed(keys)
        # Distinct pairs, a place of each, and the pair at every place.
        places = np.argsort(keys)
        keys = keys[places]
        starts = np.append(True, keys[1:] != keys[:-1])
        self.pairs, self.first = keys[starts], places[starts].astype(np.int32)
        self.pair = np.empty(len(keys), np.int32)
        self.pair[places] = np.cumsum(starts, dtype=np.int32) - 1

    def learnt(self, places: np.ndarray, n: int) -> np.ndarray:
        """How often each distinct token or pair occurs in the texts to learn from."""
        return np.bincount(places[~self.held[self.doc]], minlength=n).astype("<u4")


# Counting

_ASKED = "level int, part int, block bigint, keys binary, counts binary"


def _ask(parts: int):
    edges = _edges(parts)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                texts = _Texts(row)
                out = []
                for level, keys, places in ((1, texts.words, texts.tokens), (2, texts.pairs, texts.pair)):
                    counts = texts.learnt(places, len(keys))
                    for part, a, b in _slices(keys, edges):
                        out.append((level, part, row["block"], _packed_keys(keys[a:b]), _packed(counts[a:b])))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("level", "part", "block", "keys", "counts"), r)) for r in out],
                    schema=pa.schema(
                        [("level", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
                    ),
                )

    return kernel


_TOLD = "kind string, level int, part int, block bigint, keys binary, data binary, stats array<bigint>"


def _tell(asked: pd.DataFrame) -> pd.DataFrame:
    """Add up one part of a level: its table, its statistics, and an answer to each block.

    An answer is twice the count, plus 1 for the first block that has the key.
    """
    asked = asked.sort_values("block")
    level, part = int(asked["level"].iloc[0]), int(asked["part"].iloc[0])
    keys = [_unpacked_keys(k) for k in asked["keys"]]
    sizes = [len(k) for k in keys]
    distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    handed_in = np.concatenate([_unpacked(c, "<u4") for c in asked["counts"]])
    counts = np.bincount(place, weights=handed_in, minlength=len(distinct)).astype(np.int64)
    answer = counts[place] * 2
    answer[first] += 1
    known = counts > 0
    of_count = [int((counts == r).sum()) for r in range(1, MOST_DISCOUNTED + 2)]
    stats = [int(counts.sum()), int(known.sum()), *of_count]
    rows = [("table", level, part, None, _packed_keys(distinct[known]), _packed(counts[known].astype("<i8")), stats)]
    for block, part_of in zip(asked["block"], np.split(answer, np.cumsum(sizes)[:-1])):
        rows.append(("answer", level, part, block, None, _packed(part_of.astype("<i8")), None))
    out = pd.DataFrame(rows, columns=["kind", "level", "part", "block", "keys", "data", "stats"])
    return out.astype({"block": "Int64"})


# Discounts


def discounts(of_count: list[int]) -> np.ndarray:
    """Factor for counts 0 .. ``MOST_DISCOUNTED`` + 1 from how many items occur 1, 2, ... times.

    Katz's form of Good-Turing, in which the discounts together free the mass of
    the items that occur once. Where the counts of counts are too few for it (a
    factor outside 0 to 1), an absolute discount takes its place.
    """
    k, n = MOST_DISCOUNTED, [0, *of_count]
    out = np.ones(k + 2)
    far = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    absolute = min(n[1] / (n[1] + 2 * n[2]), 0.9) if n[1] else 0.5
    for r in range(1, k + 1):
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (turing - far) / (1 - far) if far < 1 else 0.0
        out[r] = factor if 0 < factor < 1 else 1 - absolute / r
    return out


@dataclass(frozen=True)
class Model:
    """What all tasks know of the corpus: totals and discounts."""

    tokens: int
    distinct: int
    texts: int
    of_token: np.ndarray
    of_pair: np.ndarray
    discounted: float  # sum of the discounted counts of all tokens

    @staticmethod
    def _worth(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
        return counts * factors[np.minimum(counts, MOST_DISCOUNTED + 1)]

    def alone(self, counts: np.ndarray) -> np.ndarray:
        """Probability of tokens with these counts, whatever stands before; 0 is the class of all others."""
        # One more than all tokens if discounts free nothing for the others.
        total = self.tokens + (self.discounted >= self.tokens)
        rest = 1 - self.discounted / total
        return np.where(counts > 0, self._worth(counts, self.of_token) / total, rest)

    def pair_mass(self, counts: np.ndarray) -> np.ndarray:
        return self._worth(counts, self.of_pair)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def seen_scale(total: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """What the discounted counts after a token are divided by, so that something is left for other tokens."""
    return total + (mass >= total)


# Scoring

_SCORED = "kind string, part int, block bigint, keys binary, data binary, ids array<{id}>, held array<boolean>, n array<bigint>, known array<bigint>, base array<double>, score array<double>"


def _answers(rows: list[dict], level: int, n: int) -> np.ndarray:
    parts = sorted((r["part"], r["data"]) for r in rows if r["level"] == level)
    out = np.concatenate([_unpacked(d, "<i8") for _, d in parts])
    assert len(out) == n
    return out


def _score(model: Model, parts: int, names: list[str], schema: pa.Schema):
    """Score what was learnt, and hand in what backoff weights are made of.

    Every learnt pair is handed in once, by its first block: for each token the
    discounted counts of the pairs it begins, and the probability that their
    second tokens have alone. Asked for are tokens before something that was not
    learnt, which only held-out texts have, and those that may lack a discount.
    """
    edges = _edges(parts)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                t = _Texts(row)
                counts = _answers(row["answers"], 1, len(t.words)) >> 1
                pairs = _answers(row["answers"], 2, len(t.pairs))
                own, pairs = (pairs & 1).astype(bool), pairs >> 1
                alone = model.alone(counts)
                context = counts.copy()
                context[np.searchsorted(t.words, _START)] = model.texts
                before, after = t.before[t.first], t.tokens[t.first]
                mine = own & (pairs > 0)
                mass = np.bincount(before[mine], model.pair_mass(pairs[mine]), len(t.words))
                covered = np.bincount(before[mine], alone[after[mine]], len(t.words))

                hand = np.flatnonzero(mass > 0)
                seen, known = pairs[t.pair] > 0, context[t.before] > 0
                with np.errstate(divide="ignore"):
                    of_pair = np.log10(model.pair_mass(pairs))[t.pair]
                    of_token, of_context = np.log10(alone)[t.tokens], np.log10(context)[t.before]
                # A discounted pair shows that the divisor is the count itself; else it is asked for.
                some = np.bincount(before, (pairs > 0) & (pairs <= MOST_DISCOUNTED), len(t.words)) > 0
                settled = seen & some[t.before]
                score = np.where(seen, of_pair, of_token) - np.where(settled, of_context, 0)
                asks = known & ~settled
                need = np.unique(t.before[asks])
                out = []
                for part, a, b in _slices(t.words[hand], edges):
                    i = hand[a:b]
                    data = np.stack([context[i].astype(float), mass[i], covered[i]], axis=1).reshape(-1)
                    out.append(("sums", part, row["block"], _packed_keys(t.words[i]), _packed(data.astype("<f8")), *[None] * 6))
                for part, a, b in _slices(t.words[need], edges):
                    out.append(("need", part, row["block"], _packed_keys(t.words[need[a:b]]), None, *[None] * 6))
                # Which divisor (even) or backoff weight (odd) each token adds, by place among the needed.
                uses = np.searchsorted(need, t.before[asks]) * 2 + ~seen[asks]
                uses += t.doc[asks].astype(np.int64) * (2 * len(need) + 2)
                which, often = np.unique(uses, return_counts=True)
                data = _packed(np.stack([which, often], axis=1).astype("<i8").reshape(-1))
                docs = len(t.lengths)
                summed = [np.bincount(t.doc, x, docs) for x in (model.base(counts)[t.tokens], score)]
                n_known = np.bincount(t.doc, counts[t.tokens] > 0, docs).astype(np.int64)
                out.append(
                    ("texts", len(need), row["block"], None, data, t.ids, t.held.tolist(), t.lengths.tolist(), n_known.tolist(), *[s.tolist() for s in summed])
                )
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=schema)

    return kernel


def _weights(rows: pd.DataFrame) -> pd.DataFrame:
    """Divisors and backoff weights of one part, as logarithms: its table, and an answer to each block."""
    rows = rows.sort_values(["kind", "block"])
    part = int(rows["part"].iloc[0])
    sums = rows[rows["kind"] == "sums"]
    keys = [_unpacked_keys(k) for k in sums["keys"]] or [np.zeros(0, np.uint64)]
    data = [_unpacked(d, "<f8").reshape(-1, 3) for d in sums["data"]] or [np.zeros((0, 3))]
    distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    handed_in = np.concatenate(data)
    total = handed_in[first, 0]
    mass, covered = (np.bincount(place, handed_in[:, i], len(distinct)) for i in (1, 2))
    scale = seen_scale(total, mass)
    logs = np.log10(np.stack([1 / scale, (1 - mass / scale) / (1 - covered)], axis=1))
    out = [("table", part, None, _packed_keys(distinct), _packed(logs.astype("<f8").reshape(-1)))]
    need = rows[rows["kind"] == "need"]
    for block, asked in zip(need["block"], need["keys"]):
        answer = logs[np.searchsorted(distinct, _unpacked_keys(asked))]
        out.append(("answer", part, block, None, _packed(answer.astype("<f8").reshape(-1))))
    return pd.DataFrame(out, columns=["kind", "part", "block", "keys", "data"]).astype({"block": "Int64"})


def _finish(kind: pa.DataType):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                parts = sorted((r["part"], r["data"]) for r in row["weights"] or [])
                logs = np.concatenate([_unpacked(d, "<f8") for _, d in parts] or [np.zeros(0)])
                assert len(logs) == 2 * row["part"]
                which, often = _unpacked(row["data"], "<i8").reshape(-1, 2).T
                doc, use = np.divmod(which, len(logs) + 2)
                more = np.bincount(doc, logs[use] * often, len(row["ids"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], kind),
                        pa.array(row["held"], pa.bool_()),
                        pa.array(row["n"], pa.int64()),
                        pa.array(row["known"], pa.int64()),
                        pa.array(row["base"], pa.float64()),
                        pa.array(np.array(row["score"]) + more),
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    return kernel


def _bucketed(blocks: DataFrame) -> tuple[DataFrame, str]:
    """Write blocks down in buckets by number: answers are brought to them, the texts stay where they are.

    Returns them with the name of their table, which only lists files in the shared folder.
    """
    spark = blocks.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_folder(spark)}/{name}"
    blocks.write.bucketBy(buckets, "block").saveAsTable(name, format="parquet", path=path)
    return spark.table(name), name


def katz_scores(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    tables: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Texts are lower-cased (A-Z) words, closed by an end token. The model learns
    from the documents that are not held out and scores all, in log10. The count
    tables of both levels and the backoff weights are written to ``tables`` in
    ``parts`` parts of the key space (by default one for each ``PART_WORDS`` words).

    - NULL and empty texts are the end token alone.
    - A NULL ``held_out`` counts as held out.
    - Repeated rows and ids count and are scored one by one.
    - If nothing can be learnt, the class of unknown tokens has probability 1.
    - An empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    tables = tables or f"{shared_folder(spark)}/katz-{uuid.uuid4().hex}"
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(held_out, F.lit(True)).alias("held"),
        F.col(text_col).cast("binary").alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    arrow = to_arrow_type(rows.schema["id"].dataType)
    blocks, name = _bucketed(
        rows.mapInArrow(
            _blocks, f"ids array<{kind}>, held array<boolean>, lengths array<bigint>, words binary, often binary, tokens binary"
        ).withColumn("block", F.monotonically_increasing_id())
    )

    words = F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b))
    parts = parts or max(-(-(blocks.agg(words).first()[0] or 0) // PART_WORDS), 2)

    counted = f"{tables}/counts"
    blocks.mapInArrow(_ask(parts), _ASKED).groupBy("level", "part").applyInPandas(_tell, _TOLD).write.parquet(counted)
    told = spark.read.schema(_TOLD).parquet(counted)
    learnt = F.sum(F.size(F.filter("held", lambda h: ~h)))
    model = _model(told, blocks.agg(learnt.cast("long")).first()[0] or 0)

    answers = told.filter("kind = 'answer'").groupBy("block")
    answers = answers.agg(F.collect_list(F.struct("level", "part", "data")).alias("answers"))
    scored_type = _SCORED.format(id=kind)
    names = [f.split()[0] for f in scored_type.split(", ")]
    lists = [pa.list_(t) for t in (arrow, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *lists]
    scored = staged(
        blocks.join(answers, "block").mapInArrow(
            _score(model, parts, names, pa.schema(list(zip(names, types)))), scored_type
        ),
        "scored",
    )
    spark.sql(f"drop table {name}")

    backoff = f"{tables}/backoff"
    handed = scored.filter("kind <> 'texts'").select("kind", "part", "block", "keys", "data")
    weights_type = "kind string, part int, block bigint, keys binary, data binary"
    handed.groupBy("part").applyInPandas(_weights, weights_type).write.parquet(backoff)
    weights = spark.read.schema(weights_type).parquet(backoff).filter("kind = 'answer'").groupBy("block")
    weights = weights.agg(F.collect_list(F.struct("part", "data")).alias("weights"))
    texts = scored.filter("kind = 'texts'").drop("kind", "keys").join(weights, "block", "left")
    out = texts.mapInArrow(
        _finish(arrow), f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return out.select(
        "id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _model(told: DataFrame, texts: int) -> Model:
    """Totals and discounts, from one row of statistics for each level."""
    width = MOST_DISCOUNTED + 3
    sums = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(width)]
    stats = {level: [0] * width for level in _LEVELS}
    for r in told.filter("kind = 'table'").groupBy("level").agg(*sums).collect():
        stats[r.level] = [r[f"s{i}"] for i in range(width)]
    of_token, of_pair = (discounts(stats[level][2:]) for level in _LEVELS)
    tokens, distinct, *of_count = stats[1]
    discounted = float(tokens) - sum(r * n * (1 - of_token[r]) for r, n in enumerate(of_count[:-1], 1))
    return Model(tokens, distinct, texts, of_token, of_pair, discounted)
