"""Which tokens of two tokenizers cover the same bytes, and how often they do."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerloom.llm.rows import wrapped
from layerloom.storage import staged

#: Bytes of text that are aligned at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 21
#: Characters of units that a Python worker remembers; beyond it, it learns them anew.
KNOWN_CHARS = 4_000_000

_PAIR_BITS = 32  # of a pair's number, the id of the second tokenizer

# A unit starts with a space that no white space precedes. Neither tokenizer joins
# bytes across such a place, so the tokens of a text are those of its units.
_WHITE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_UNIT = re.compile(rf" [^ ]*(?:(?<=[{_WHITE}]) +[^ ]*)*")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Units of text, as the groups in which the tokens of two tokenizers end together."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self._a = Tokenizer.from_file(byte_level)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters = _byte_letters()
        vocabulary = self._a.get_vocab(with_added_tokens=True)
        self._bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self._bytes_a[i] = bytes(letters[c] for c in token) if known else token.encode()
        self._bytes_b = [self._piece(self._b.id_to_piece(i)) for i in range(len(self._b))]
        self._space = self._b.piece_to_id("▁")
        self.forget()

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.links, self.ends = array("q"), array("q", [0])  # numbers of the linked pairs, and where each unit's end
        self._sizes = array("i")  # of each unit: tokens of both, groups, links, and 1 if both give the text back
        self.chars = 0

    def sizes(self) -> np.ndarray:
        return np.array(self._sizes, np.int32).reshape(-1, 5)

    def learn(self, units: list[str]) -> None:
        """Align units that are not known yet."""
        of_a = self._a.encode_batch_fast(units, add_special_tokens=False)
        of_b = self._b.encode([u[1:] for u in units], num_threads=1)
        for unit, a, b in zip(units, of_a, of_b):
            # The library puts the space back, but not before an empty text.
            self._add(unit, a.ids, b if len(unit) > 1 else [self._space])
            self.chars += len(unit)

    def _add(self, unit: str, a: list[int], b: list[int]) -> None:
        self.number[unit] = len(self.groups)
        raw = unit.encode()
        bytes_a, bytes_b = [self._bytes_a[i] for i in a], [self._bytes_b[i] for i in b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            self.groups.append("")
            self._sizes.extend((0, 0, 0, 0, 0))
            self.ends.append(len(self.links))
            return
        groups, before = [], len(self.links)
        i = j = first_i = first_j = at_a = at_b = 0
        while i < len(a) or j < len(b):
            # The tokens that end next; both, where a group ends.
            end_a = at_a + len(bytes_a[i]) if i < len(a) else at_a
            end_b = at_b + len(bytes_b[j]) if j < len(b) else at_b
            self.links.append(a[i] << _PAIR_BITS | b[j])
            if end_a <= end_b:
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(f"{','.join(map(str, a[first_i:i]))}|{','.join(map(str, b[first_j:j]))}")
                first_i, first_j = i, j
        self.groups.append(";".join(groups))
        self._sizes.extend((len(a), len(b), len(groups), len(self.links) - before, 1))
        self.ends.append(len(self.links))


def units_of(text: str) -> list[str]:
    return _UNIT.findall(" " + text)


@lru_cache(maxsize=1)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One aligner per worker, with what it knows."""
    return Aligner(byte_level, pieces)


def _runs(ends: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs with the numbers ``of``, one after the other, and their lengths."""
    n = ends[of + 1] - ends[of]
    return np.repeat(ends[of] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


_BLOCK = ["block", "pairs", "weights", "keys", "sizes", "digests", "units", "text_ends", "links", "link_ends"]
_BLOCK_SCHEMA = (
    "block bigint, pairs array<bigint>, weights array<bigint>, keys binary, sizes binary, digests binary, "
    "units binary, text_ends binary, links binary, link_ends binary"
)


def _aligned(known: Aligner, keys: list[bytes], texts: list[str], copies: list[int]) -> list:
    """The columns of a block: its linked pairs with their weights, and what its texts are made of.

    ``links`` are places in ``pairs`` for each unit of the block, ``units`` are
    the units of each text; both are numbered within the block.
    """
    if known.chars > KNOWN_CHARS:
        known.forget()
    units = [units_of(t) for t in texts]
    known.learn([u for u in dict.fromkeys(chain.from_iterable(units)) if u not in known.number])
    numbers = [np.fromiter(map(known.number.__getitem__, u), np.int64, len(u)) for u in units]
    every, digests, sizes = known.sizes(), [], np.zeros((len(texts), 4), np.int64)
    for k, found in enumerate(numbers):
        if every[found, 4].all():
            sizes[k] = every[found, :4].sum(axis=0)
            joined = ";".join(map(known.groups.__getitem__, found.tolist()))
            digests.append(hashlib.sha256(joined.encode()).digest())
        else:
            numbers[k] = found[:0]
            digests.append(bytes(32))
    n = np.array([len(x) for x in numbers], np.int64)
    distinct, of = np.unique(np.concatenate(numbers), return_inverse=True)
    weight = np.bincount(of, np.repeat(np.array(copies, float), n), len(distinct))
    at, per_unit = _runs(np.frombuffer(known.ends, np.int64), distinct)
    pairs, links = np.unique(np.frombuffer(known.links, np.int64)[at], return_inverse=True)
    weights = np.bincount(links, np.repeat(weight, per_unit), len(pairs)).astype(np.int64)
    return [
        pairs.tolist(),
        weights.tolist(),
        b"".join(keys),
        sizes.tobytes(),
        b"".join(digests),
        of.astype(np.uint32).tobytes(),
        np.cumsum(n).tobytes(),
        links.astype(np.uint32).tobytes(),
        np.cumsum(per_unit).tobytes(),
    ]


def _align(byte_level: str, pieces: str):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = aligner(byte_level, pieces), TaskContext.get().partitionId()
        made, size, waiting = 0, 0, ([], [], [])

        def block():
            kinds = [pa.list_(pa.int64())] * 2 + [pa.binary()] * 7
            columns = [pa.array([c], k) for c, k in zip(_aligned(known, *waiting), kinds)]
            number = pa.array([part << 32 | made], pa.int64())
            return pa.RecordBatch.from_arrays([number, *columns], names=_BLOCK)

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "text", "copies")]
            for row in range(batch.num_rows):
                for held, column in zip(waiting, columns):
                    held.append(column[row].as_py())
                size += len(waiting[1][-1])
                if size >= BLOCK_BYTES:
                    yield block()
                    made, size, waiting = made + 1, 0, ([], [], [])
        if waiting[0]:
            yield block()

    return kernel


_SIZES = ["n_a", "n_b", "n_groups", "n_links"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Measures of each text of a block, from the counts of the block's pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = {c: batch.column(c)[row].as_py() for c in _BLOCK[3:]}
            answers = batch.column("answers")[row].values.flatten()
            place, count, best = (a.to_numpy(zero_copy_only=False) for a in answers)
            per_pair = np.zeros((len(place), 2), np.int64)
            per_pair[place] = np.stack([best, count], axis=1)
            sizes = np.frombuffer(get["sizes"], np.int64).reshape(-1, 4)
            links, units = np.frombuffer(get["links"], np.uint32), np.frombuffer(get["units"], np.uint32)
            per_unit = _sums(per_pair[links], np.frombuffer(get["link_ends"], np.int64))
            per_text = _sums(per_unit[units], np.frombuffer(get["text_ends"], np.int64))
            n = len(sizes)
            keys = [get["keys"][32 * k : 32 * k + 32] for k in range(n)]
            digests = [get["digests"][32 * k : 32 * k + 32].hex() if sizes[k, 2] else "" for k in range(n)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    *[pa.array(np.ascontiguousarray(c)) for c in [*sizes.T, *per_text.T]],
                    pa.array(digests),
                ],
                names=["key", *_SIZES, "n_best", "count_sum", "digest"],
            )


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows up to each end."""
    upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(values, axis=0)])
    return upto[ends] - upto[np.r_[0, ends[:-1]]]


class Alignment:
    """Documents in two tokenizations, aligned where both have a token end.

    ``byte_level`` is a file of the tokenizers library, applied to a space and
    the text; ``pieces`` is a SentencePiece model, which adds the space itself.
    Tokens of both that share a byte are linked. A text of which either side
    does not give the bytes back has no tokens.

    Rows meet by their full text, so each distinct text is tokenized and aligned
    once; counts of linked pairs are weighted by how often the text occurs, and
    the measures are joined to all rows that have it by the SHA-256 of the text.

    Texts are worked on in blocks. A block asks for each of its distinct pairs
    once; the pairs are added up, ranked and joined back to the blocks that asked.

    - NULL and empty texts have no tokens: zeros and an empty digest.
    - Repeated rows and ids give one row each; an empty table gives an empty result.
    - Names of special tokens within texts are plain text.
    - Further columns are ignored, whatever their names.
    """

    def __init__(self, docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text"):
        rows = wrapped(docs, id_col, text_col)
        texts = rows.filter(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
        key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
        self._rows = rows.select("id", F.when(F.length("text") > 0, key).alias("key"))
        aligned = texts.select(key.alias("key"), "text", "copies").mapInArrow(_align(byte_level, pieces), _BLOCK_SCHEMA)
        self._blocks = staged(aligned, "aligned", compression="zstd")
        self._counts = None

    def counts(self) -> DataFrame:
        """pair, n, best: how many links hold a pair of ids, and whether no pair with its second id has more."""
        if self._counts is None:
            each = self._blocks.select(F.inline(F.arrays_zip("pairs", "weights"))).toDF("pair", "weight")
            counts = staged(each.groupBy("pair").agg(F.sum("weight").alias("n")), "pairs")
            second = F.col("pair").bitwiseAND((1 << _PAIR_BITS) - 1).alias("second")
            most = counts.groupBy(second).agg(F.max("n").alias("most"))
            ranked = counts.withColumn("second", second).join(most, "second")
            self._counts = staged(ranked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
        return self._counts

    def pairs(self) -> DataFrame:
        """a, b, n: the linked ids of both tokenizers, and how many links hold them."""
        second = F.col("pair").bitwiseAND((1 << _PAIR_BITS) - 1)
        return self.counts().select(F.shiftright("pair", _PAIR_BITS).alias("a"), second.alias("b"), "n")

    def measures(self) -> DataFrame:
        """id, n_a, n_b, n_groups, n_links, n_best, count_sum and digest of every row.

        ``n_best`` counts the links whose pair is the most frequent one of its
        second id, ``count_sum`` adds up the counts of all links. The digest is
        the SHA-256 of the groups, as ``a1,a2|b1;a3|b2``.
        """
        asked = self._blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
        answer = F.struct("place", "n", "best")
        answers = asked.join(self.counts(), "pair").groupBy("block").agg(F.collect_list(answer).alias("answers"))
        told = self._blocks.drop("pairs", "weights").join(answers, "block", "left")
        kind = "array<struct<place int, n bigint, best boolean>>"  # empty where no text of a block has a token
        told = told.withColumn("answers", F.coalesce("answers", F.array().cast(kind)))
        numbers = [*_SIZES, "n_best", "count_sum"]
        columns = ", ".join(f"{c} bigint" for c in numbers)
        found = told.mapInArrow(_measure, f"key binary, {columns}, digest string")
        joined = self._rows.join(staged(found, "measures"), "key", "left")
        return joined.select(
            "id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("digest", F.lit("")).alias("digest")
        )
