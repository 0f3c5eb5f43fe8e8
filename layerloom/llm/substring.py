"""Repeated passages across documents: seed on winnowed anchors, extend, remove."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.rows import ROW, with_row_key, wrapped
from layerloom.llm.words import RunHashes, mixed, word_hashes
from layerloom.storage import staged

#: Words of a seed; a repeat of ``length`` words holds at least one common anchor.
SEED_WORDS = 8
_CHUNK_WORDS = 1 << 18

_SEEDS = "anchor bigint, context bigint, row bigint, start int, n int, again boolean"
_WINDOWS = "anchor bigint, hash bigint, row bigint, start int, again boolean"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[list[bytes]], pa.RecordBatch]]:
    """Rows and words of some documents at a time; a very long document is a chunk of its own."""
    for batch in batches:
        texts, first, size, words = batch.column("text"), 0, 0, []
        for i in range(batch.num_rows):
            words.append((texts[i].as_py() or b"").split())
            size += len(words[-1])
            if size >= _CHUNK_WORDS or i + 1 == batch.num_rows:
                part = batch.slice(first, i + 1 - first)
                yield part.column("row").to_pylist(), words, part
                first, size, words = i + 1, 0, []


class _Anchored:
    """The windows of some documents, each with the anchor that winnowing picks for it.

    Windows are runs of ``length`` words. The anchor of a window is its seed with
    the smallest hash, the leftmost if several have it: it depends on nothing but
    the window's words, so equal windows have equal anchors.
    """

    def __init__(self, words: list[list[bytes]], length: int):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(sizes) - sizes
        counts = np.maximum(sizes - length + 1, 0)
        self.doc = np.repeat(np.arange(len(words)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.start = within  # of each window, counted in its document
        self.at = self.first[self.doc] + within if len(within) else within
        if len(within) == 0:
            self.anchor_at = self.anchor = np.zeros(0, np.int64)
            return
        self.runs = RunHashes(word_hashes([w for of_doc in words for w in of_doc]))
        seed = min(SEED_WORDS, length)
        seeds = np.arange(self.first[-1] + sizes[-1] - seed + 1)
        hashes = self.runs.of(seeds, seeds + seed)
        lowest = sliding_window_view(hashes, length - seed + 1)[self.at].argmin(axis=1)
        self.anchor_at = self.at + lowest
        self.anchor = hashes[self.anchor_at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _is_again(row: np.ndarray, start: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether an entry with the same keys stands earlier among these."""
    order = np.lexsort((start, row, *keys))
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    # An equal (row, start) is the same place met twice, not an earlier one.
    earlier = np.zeros(len(order), bool)
    earlier[order[1:]] = same
    return earlier


def _seeds(length: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, _ in _chunks(batches):
            w = _Anchored(words, length)
            if not len(w.at):
                continue
            cut = np.flatnonzero(
                np.r_[True, (w.anchor_at[1:] != w.anchor_at[:-1]) | (w.doc[1:] != w.doc[:-1])]
            )
            n = np.diff(np.r_[cut, len(w.at)])
            context = w.runs.of(w.at[cut], w.at[cut] + n - 1 + length) ^ n.astype(np.uint64)
            row, start, anchor = np.array(rows, np.int64)[w.doc[cut]], w.start[cut], w.anchor[cut]
            again = _is_again(row, start, context, anchor)
            # What is known to be repeated needs no partner any more: deal it out evenly.
            with np.errstate(over="ignore"):
                spread = mixed(row.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64))
            anchor = np.where(again, spread, anchor)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(anchor),
                    _signed(context),
                    pa.array(row),
                    pa.array(start.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(again),
                ],
                names=["anchor", "context", "row", "start", "n", "again"],
            )

    return kernel


def _windows(length: int):
    """The windows of given runs, one row each."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, part in _chunks(batches):
            w = _Anchored(words, length)
            wanted = np.zeros(len(w.at) + 1, np.int64)
            first_window = np.searchsorted(w.doc, np.arange(len(words)))
            for i, runs in enumerate(part.column("runs").to_pylist()):
                for run in runs:
                    wanted[first_window[i] + run["start"]] += 1
                    wanted[first_window[i] + run["start"] + run["n"]] -= 1
            take = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
            if not len(take):
                continue
            row, start, anchor = np.array(rows, np.int64)[w.doc[take]], w.start[take], w.anchor[take]
            hashes = w.runs.of(w.at[take], w.at[take] + length)
            again = _is_again(row, start, hashes, anchor)
            yield pa.RecordBatch.from_arrays(
                [_signed(anchor), _signed(hashes), pa.array(row), pa.array(start.astype(np.int32)), pa.array(again)],
                names=["anchor", "hash", "row", "start", "again"],
            )

    return kernel


def _keeper(length: int):
    """Cut the words covered by repeated windows out of each text; ``text`` is NULL where none are."""

    def kernel(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, of_rows in batches:
            n_words, n_removed, digests, cut = [], [], [], []
            for text, runs in zip(texts, of_rows):
                words, runs = (text.as_py() or b"").split(), runs.as_py()
                covered = np.zeros(len(words) + 1, np.int32)
                for run in runs or ():
                    covered[run["start"]] += 1
                    covered[run["start"] + run["n"] - 1 + length] -= 1
                kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0).tolist()
                joined = b" ".join(words if len(kept) == len(words) else [words[i] for i in kept])
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined).hexdigest())
                cut.append(None if n_removed[-1] == 0 else joined)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(cut, pa.binary()),
                ],
                names=["n_words", "n_removed", "kept_sha256", "cut"],
            )

    columns = "n_words bigint, n_removed bigint, kept_sha256 string, cut binary"
    return F.arrow_udf(kernel, columns).asNondeterministic()


def _with_repeat(places: DataFrame, kind: str) -> DataFrame:
    """Add ``repeat``: whether the same kind stands at an earlier place of the same anchor."""
    place = F.struct("row", "start")
    # Written down: Spark splits a frequent key of a join, but not beneath an aggregate.
    firsts = staged(places.groupBy("anchor", kind).agg(F.min(place).alias("first")), "firsts")
    return places.join(firsts, ["anchor", kind]).withColumn("repeat", place != F.col("first"))


def _repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    """(row, runs): the runs of windows of each document that also start earlier.

    ``texts`` has row and text. Seed: documents meet on the hash of their
    anchors. Extend: around an anchor both ways lie the windows that it is the
    anchor of. Where the whole stretch equals that of an earlier place, all its
    windows are repeats, and neighbouring stretches make up the maximal repeat.
    Where an anchor has different stretches, the first of each kind is opened
    and its windows are compared one by one.

    Every stretch and window is compared with the first of its kind only, and
    each task sends one row for a kind, so copies are never paired with each other.
    Anchors and kinds are aggregated and joined back, so no task has to hold all
    places of a frequent anchor.
    """
    seeds = staged(texts.mapInArrow(_seeds(length), _SEEDS), "seeds")
    met = seeds.filter("not again").drop("again")
    shared = staged(
        met.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("places"), (F.min("context") != F.max("context")).alias("several"))
        .filter("places > 1")
        .drop("places"),
        "anchors",
    )
    stretches = _with_repeat(staged(met.join(shared, "anchor"), "shared"), "context")
    known = seeds.filter("again").select("row", "start", "n", F.lit(True).alias("repeat"))
    found = staged(
        stretches.filter("repeat or several").select("row", "start", "n", "repeat").union(known), "stretches"
    )
    run = F.struct("start", "n")
    opened = found.filter("not repeat").groupBy("row").agg(F.collect_list(run).alias("runs"))
    windows = staged(texts.join(opened, "row").mapInArrow(_windows(length), _WINDOWS), "windows")
    one = ["row", "start", F.lit(1).alias("n")]
    single = _with_repeat(windows.filter("not again"), "hash").filter("repeat").select(*one)
    single = single.union(windows.filter("again").select(*one))
    repeats = found.filter("repeat").select("row", "start", "n").union(single)
    return staged(repeats.groupBy("row").agg(F.collect_list(run).alias("runs")), "repeats")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    length: int = 20,
    with_text: bool = True,
) -> DataFrame:
    """Remove every word covered by a run of ``length`` words that also starts earlier.

    Earlier is a smaller id, or a smaller start in the same document. Returns
    doc (a struct of the other columns), n_words, n_removed, kept_sha256 (of the
    kept words joined by one space) and, if asked for, text: the kept words
    joined by one space, or the text as it was if no word was removed.

    Runs count as equal if two 64-bit hashes agree, of the run and of its anchor.

    - A NULL text has no words and stays NULL; an empty text stays empty.
    - Texts shorter than a run lose nothing.
    - Rows that share an id come in the order of their texts; rows without an id come last.
    - An empty table gives an empty result.
    """
    keyed = with_row_key(wrapped(docs, id_col, text_col), "id", ["text"])
    others = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != text_col]
    keyed = keyed.select(
        F.col(ROW).alias("row"), F.struct(*others).alias("doc"), F.col("text").cast("binary").alias("text")
    )
    repeats = _repeated_runs(keyed.select("row", "text"), length)
    found = keyed.join(repeats, "row", "left").select("doc", "text", _keeper(length)("text", "runs").alias("found"))
    columns = ["doc", "found.n_words", "found.n_removed", "found.kept_sha256"]
    if with_text:
        # Only what was cut comes back from Python; other texts stay as they were.
        columns.append(F.coalesce("found.cut", "text").cast("string").alias("text"))
    return found.select(*columns)
