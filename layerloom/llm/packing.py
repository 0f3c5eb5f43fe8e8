"""Pack documents into sequences that keep the token shares of their sources."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.rows import ROW, running_total, with_row_key, wrapped
from layerloom.llm.tokens import encoder
from layerloom.storage import staged

#: A queue that is due less than one id a window saves up for a turn of so many ids.
QUANTUM = 16
_CHUNK = 256


def _share(places: np.ndarray, upto: np.ndarray, total: int) -> np.ndarray:
    """``places * upto // total``, exact up to 2**50 though the product leaves 64 bits."""
    guess = (places.astype(float) * upto / total).astype(np.int64)
    # The guess is off by a few at most, so what is left fits even if the products wrap.
    return guess + (places * upto - guess * total) // total


@dataclass(frozen=True)
class Rounds:
    """Deficit round-robin over members with ``total`` ids in all, in rounds of ``every`` ids.

    The members lie side by side on 0 .. total. When p ids are dealt, the one at
    low .. high has put in ``p * high // total - p * low // total``: its exact
    share but for less than one id, the deficit that the next round pays. Every
    member is due at least one id a round, so what it has put in never falls.
    """

    total: int
    every: int
    first: int  # ids of the first round, which may start within a window
    rest: int  # where the last member begins, which stands for all queues of the next level

    def _edge(self, k: np.ndarray) -> np.ndarray:
        return np.where(k <= 0, 0, np.minimum(self.first + (k - 1) * self.every, self.total))

    def _round_at(self, place: np.ndarray) -> np.ndarray:
        place = np.clip(place, 0, self.total - 1).astype(np.int64)
        return np.where(place < self.first, 0, 1 + (place - self.first) // self.every)

    def dealt(self, low, high, start, begin, length):
        """Where ids ``begin .. begin + length`` of members at low .. high are dealt.

        Returns low and high of the whole for the next level up, and the runs as
        (start in the document, place among the ids dealt, length), and the run
        each of them is a part of.
        """
        rate = (high - low) / self.total
        k0, k1 = self._round_at((begin - 2) / rate), self._round_at((begin + length + 2) / rate)
        n = k1 - k0 + 1
        i = np.repeat(np.arange(len(n)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + k0[i]
        now, then = self._edge(k), self._edge(k + 1)
        ahead, ahead_then = _share(now, low[i], self.total), _share(then, low[i], self.total)
        own, own_then = _share(now, high[i], self.total) - ahead, _share(then, high[i], self.total) - ahead_then
        a, b = np.maximum(own, begin[i]), np.minimum(own_then, (begin + length)[i])
        held = a < b
        i, a, b = i[held], a[held], b[held]
        place = (now + ahead_then - ahead - own)[held] + a
        return start[i] + a - begin[i], place, b - a, i


@dataclass(frozen=True)
class Phase:
    """A part of the stream in which the shares of the queues stay the same.

    Queues due at least one id a window take turns in ``levels[0]``; its last
    member stands for the others, which take longer turns in the levels below.
    """

    first: int  # place in the stream of all ids
    levels: Mapping[int, int]  # level of a queue -> its rounds
    rounds: Sequence[Rounds]

    def dealt(self, level: int, low, high, start, begin, length):
        """(start in the document, place in the stream, length, index of the run given) of some runs."""
        at = self.levels[level]
        which = np.arange(len(start))
        for k in range(at, -1, -1):
            turns = self.rounds[k]
            start, begin, length, i = turns.dealt(low, high, start, begin, length)
            which = which[i]
            above = self.rounds[k - 1]
            low, high = np.full(len(i), above.rest), np.full(len(i), above.total)
        return start, self.first + begin, length, which


@dataclass(frozen=True)
class Level:
    """What is known of the queues of one level: in all, and the smallest one."""

    number: int
    ids: int
    members: int
    least: int
    queue: str


def phase_of(found: Sequence[Level], first: int, window: int) -> tuple[Phase, dict[str, int]]:
    """The rounds of a phase that starts at place ``first``, and the levels of queues that were moved.

    If the queues below a level are due less than one id in its rounds all
    together, its smallest queue goes down to them.
    """
    total = sum(v.ids for v in found)
    levels, rounds, moved = {0: 0}, [], {}
    carried = 0  # ids of the queue that came from the level above
    found = sorted(found, key=lambda v: v.number)
    if found[0].number:
        rounds.append(Rounds(total, window, window - first % window, 0))
    for i, v in enumerate(found):
        own, members = v.ids + carried, v.members + (carried > 0)
        carried, rest = 0, total - own
        every = window if v.number == 0 else max(-(-QUANTUM * total // v.least), 1)
        if rest and rest * every < total:
            if v.number and members == 1:
                every = -(-total // rest)
            else:
                carried = v.least
                moved[v.queue] = found[i + 1].number
        start = window - first % window if v.number == 0 else every
        levels[v.number] = len(rounds)
        rounds.append(Rounds(total, every, start, own - carried))
        total = rest + carried
    return Phase(first, levels, rounds), moved


def takes_of(left: Mapping[str, int], shares: Mapping[str, float]) -> list[dict[str, int]]:
    """What each queue with a share puts into each phase; a phase ends when a queue runs out."""
    left = {q: n for q, n in left.items() if n > 0 and shares.get(q, 0) > 0}
    out = []
    while left:
        time = {q: n / shares[q] for q, n in left.items()}
        end = min(time.values())
        take = {q: n if time[q] <= end else min(n, round(end * shares[q])) for q, n in left.items()}
        out.append({q: n for q, n in take.items() if n})
        left = {q: n - take[q] for q, n in left.items() if n > take[q]}
    return out


_TURN = ["begin", "ids", "phase", "level", "low"]


def pieces(phases: Sequence[Phase], window: int, before: np.ndarray, n: np.ndarray, of: np.ndarray, turns: Mapping[str, np.ndarray]):
    """(document, start, length, sequence, offset) of documents that lie at before .. before + n of their queues.

    ``turns`` are the parts of the queues that meet the documents ``of``, as arrays:
    begin and ids (places of the queue), phase, level and low (within the level).
    """
    low = np.maximum(before[of], turns["begin"])
    high = np.minimum(before[of] + n[of], turns["begin"] + turns["ids"])
    found = []
    kinds = np.unique(np.stack([turns["phase"], turns["level"]]), axis=1).T if len(of) else []
    for phase, level in kinds:
        t = np.flatnonzero((turns["phase"] == phase) & (turns["level"] == level) & (low < high))
        start, place, length, which = phases[phase].dealt(
            level,
            turns["low"][t],
            (turns["low"] + turns["ids"])[t],
            (low - before[of])[t],
            (low - turns["begin"])[t],
            (high - low)[t],
        )
        found.append(np.stack([of[t[which]], start, length, place], axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    doc, start, length, place = rows.T
    # Runs that go on where the last one ended, in the same window, are one piece.
    on = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + length[:-1]) & (place[1:] // window == place[:-1] // window)
    cut = np.flatnonzero(np.r_[True, ~on]) if len(rows) else np.zeros(0, np.int64)
    length = np.add.reduceat(length, cut) if len(rows) else length
    return doc[cut], start[cut], length, place[cut] // window, place[cut] % window


def _tokenize(path: str, end: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        close = np.array([end], enc.dtype).tobytes()
        for batch in batches:
            ids = [x + close for x in enc.encode(batch.column("text"))]
            n = [len(x) // enc.dtype.itemsize for x in ids]
            kept = [batch.column(c) for c in ("row", "id", "queue")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["row", "id", "queue", "n", "ids"]
            )

    return kernel


def _cut(path: str, phases: list[Phase], window: int, schema: list[str]):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        for batch in batches:
            for i in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(i, _CHUNK)
                before, n = (part.column(c).to_numpy() for c in ("before", "n"))
                lists = part.column("turns")
                of = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                turns = {c: v.to_numpy().astype(np.int64) for c, v in zip(_TURN, flat.flatten())}
                doc, start, length, sequence, offset = pieces(phases, window, before, n, of, turns)
                wide = [np.frombuffer(x, dtype).astype("<u4") for x in part.column("ids").to_pylist()]
                sums = [zlib.crc32(wide[d][s : s + k]) for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
                which = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(which),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                        part.column("n").take(which),
                        pa.array(sequence),
                        pa.array(offset),
                    ],
                    names=schema,
                )

    return kernel


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    end: int = 0,
    window: int = 1024,
    shares: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are tokenized with the ``tokenizer`` file, closed with the id
    ``end`` and queued by source in the order of their ids. Deficit round-robin
    fills windows of ``window`` ids from the queues in proportion to ``shares``
    (by default to the ids of each source, so that all last to the end). With
    given shares a source that runs out leaves its part to the others, and
    sources without a share come last, in proportion to their ids. Only the last
    window can be short.

    A source that is due less than one id a window saves its deficit up for a
    turn of ``QUANTUM`` ids. There may be any number of sources: their sums are
    a table, joined to the documents; only sums by level of size reach the
    driver, and one sum for each source that ``shares`` names.

    What a source has put in after so many windows is a closed form of running
    totals, so every task cuts its documents by itself; deficits pass over
    windows, partitions and documents.

    - NULL and empty texts are one id, ``end``.
    - NULL sources are a queue of their own.
    - Rows that share an id follow the order of their texts; rows without an id come last.
    - An empty table gives no pieces; further columns are ignored.
    """
    if window < 1:
        raise ValueError("window must be positive")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    keyed = with_row_key(
        wrapped(docs, id_col, text_col).select(
            "id", "text", _queue(F.col(f"doc.`{source_col}`").cast("string")).alias("queue")
        ),
        "id",
        ["text"],
    )
    kind = dict(keyed.dtypes)["id"]
    rows = keyed.select(F.col(ROW).alias("row"), "id", "queue", "text")
    ids = staged(
        rows.mapInArrow(_tokenize(tokenizer, end), f"row bigint, id {kind}, queue string, n bigint, ids binary"),
        "ids",
        compression="zstd",
    )
    left = staged(ids.groupBy("queue").agg(F.sum("n").alias("ids")), "queues")
    turns, phases = _turns(left, shares, window)
    places = running_total(ids.select("row", "queue", "n"), ["queue"], ["row"], "n", "before")
    meets = lambda t: (t["begin"] < F.col("before") + F.col("n")) & (t["begin"] + t["ids"] > F.col("before"))
    met = places.join(turns, "queue").select("row", "before", F.filter("turns", meets).alias("turns"))
    out = ", ".join(f"{c} {kind if c == 'id' else 'bigint'}" for c in names)
    return ids.drop("queue").join(met, "row").mapInArrow(_cut(tokenizer, phases, window, names), out)


def _queue(source: Column) -> Column:
    """Name of a source's queue, which is never NULL."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _turns(left: DataFrame, shares: Mapping[str | None, float] | None, window: int) -> tuple[DataFrame, list[Phase]]:
    """(queue, turns) of each queue of (queue, ids), and the phases that they speak of."""
    spark = left.sparkSession
    schema = "phase int, queue string, begin bigint, ids bigint"
    named = {"" if s is None else f"={s}": float(x) for s, x in (shares or {}).items() if x > 0}
    sizes = {r.queue: r.ids for r in left.filter(F.col("queue").isin(list(named))).collect()} if named else {}
    given, done = [], dict.fromkeys(sizes, 0)
    for phase, take in enumerate(takes_of(sizes, named)):
        given += [(phase, q, done[q], n) for q, n in take.items()]
        done |= {q: done[q] + n for q, n in take.items()}
    last = max((p for p, *_ in given), default=-1) + 1
    takes = left.filter(~F.col("queue").isin(list(named))) if named else left
    takes = takes.select(F.lit(last).alias("phase"), "queue", F.lit(0).cast("long").alias("begin"), "ids")
    if given:
        takes = takes.union(spark.createDataFrame(given, schema))
    totals = {r.phase: r.ids for r in takes.groupBy("phase").agg(F.sum("ids").alias("ids")).collect()}
    if not totals:
        empty = "array<struct<begin bigint, ids bigint, phase int, level int, low bigint>>"
        return left.select("queue", F.lit(None).cast(empty).alias("turns")), []
    total = F.get(F.lit([totals.get(p, 0) for p in range(last + 1)]).cast("array<bigint>"), F.col("phase"))
    due = total / (F.col("ids") * window)
    level = F.when(F.col("ids") >= F.ceil(total / window), 0).otherwise(F.greatest(F.ceil(F.log(due) / F.log(F.lit(4.0))), F.lit(1)))
    takes = staged(takes.withColumn("level", level.cast("int")), "takes")
    found: dict[int, list[Level]] = {}
    least = F.min(F.struct("ids", "queue")).alias("least")
    for r in takes.groupBy("phase", "level").agg(F.sum("ids").alias("ids"), F.count("ids").alias("n"), least).collect():
        found.setdefault(r.phase, []).append(Level(r.level, r.ids, r.n, r.least.ids, r.least.queue))
    phases, moves, first = [], {}, 0
    for p in range(last + 1):
        if p in found:
            phase, moved = phase_of(found[p], first, window)
            moves |= {f"{p}/{q}": k for q, k in moved.items()}
            first += totals[p]
        phases.append(phase)
    if moves:
        to = F.map_from_arrays(F.lit(list(moves)), F.lit(list(moves.values())))
        moved_to = F.try_element_at(to, F.concat(F.col("phase").cast("string"), F.lit("/"), F.col("queue")))
        takes = takes.withColumn("level", F.coalesce(moved_to, F.col("level")))
    placed = running_total(takes, ["phase", "level"], ["queue"], "ids", "low")
    turns = placed.groupBy("queue").agg(F.sort_array(F.collect_list(F.struct(*_TURN))).alias("turns"))
    return turns, phases
