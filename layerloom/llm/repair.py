"""Repair the turn structure of conversations by iterative-deepening A*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.rows import running_total
from layerloom.storage import staged

#: Turns of a conversation that one search goes over; longer ones are searched in parts.
BLOCK = 256

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
_WHITE = " \t\n\x0b\x0c\r"

# A turn's code: its initial (s, u, a, or x for any other), and whether it is intact, truncated or has to go.
_INTACT, _TRUNCATED, _GONE = "suax", "SUAX", "1234"
_CODES = _INTACT + _TRUNCATED + _GONE
_LEGAL = {"su", "ua", "au"}

# What was kept last: nothing, the system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_EXPECTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_AFTER = {"u": USER, "a": ASSISTANT}
_ROLE = {"u": "user", "a": "assistant"}
_NEVER = 1 << 40


def _lower_bounds(codes: str, ends: tuple[int, ...], closing: bool) -> list[tuple[int, int, int, int]]:
    """By turn and state, a cost that no repair of the rest can undercut.

    It is the cost of the rest under rules that forget, at the end, whether
    the last turn was the system's or an assistant's.
    """
    start, user, other = (0 if set(s) & set(ends) else _NEVER for s in ([START], [USER], [SYSTEM, ASSISTANT]))
    if closing:
        user, other = min(user, other + INSERT), min(other, user + INSERT)
        start = min(start, user + INSERT)
    out = [(start, other, user, other)]
    for c in reversed(codes):
        s, o, u = start + DELETE, other + DELETE, user + DELETE
        if c not in _GONE:
            more, role = (TRUNCATED if c in _TRUNCATED else 0), c.lower()
            as_user = user + more + (0 if role == "u" else REROLE)
            s, o, u = min(s, as_user), min(o, as_user), min(u, other + more + (0 if role == "a" else REROLE))
            if role == "s":
                s = min(s, other + more)
        user, other = min(u, o + INSERT), min(o, u + INSERT)
        start = min(s, user + INSERT)
        out.append((start, other, user, other))
    return out[::-1]


def _edits(codes: str, i: int, state: int, last: int) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, next turn, next state) in the order of the edits' letters."""
    if i < len(codes):
        yield "D", DELETE, i + 1, state
    expected = _EXPECTED[state]
    if i < last:
        yield "I", INSERT, i, _AFTER[expected]
    if i < len(codes) and codes[i] not in _GONE:
        more, role = (TRUNCATED if codes[i] in _TRUNCATED else 0), codes[i].lower()
        if role == expected:
            yield "K", more, i + 1, _AFTER[role]
        elif role == "s" and state == START:
            yield "K", more, i + 1, SYSTEM
        if role != expected:
            yield "R", REROLE + more, i + 1, _AFTER[expected]


def search(codes: str, start: int, ends: tuple[int, ...], closing: bool) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair from a state to one of ``ends``, the least in ASCII order.

    Depth-first search in the order of the letters, under a bound that grows to
    the smallest cost beyond it. ``known`` holds, for states that failed, the
    cost that is still missing at least; the first path to an end is the answer.
    After the last turn something is inserted only if ``closing`` is set.
    """
    bounds = _lower_bounds(codes, ends, closing)
    known: dict[tuple[int, int], int] = {}
    last = len(codes) + closing
    bound = bounds[0][start]
    while bound < _NEVER:
        # Frames: turn, state, cost so far, edits left to try, least cost that a failed edit asked for.
        path: list[str] = []
        stack = [[0, start, 0, _edits(codes, 0, start, last), _NEVER]]
        while stack:
            frame = stack[-1]
            i, state, cost, left, _ = frame
            if i == len(codes) and state in ends:
                return cost, "".join(path)
            for letter, price, j, then in left:
                least = max(bounds[j][then], known.get((j, then), 0))
                if cost + price + least > bound:
                    frame[4] = min(frame[4], price + least)
                    continue
                path.append(letter)
                stack.append([j, then, cost + price, _edits(codes, j, then, last), _NEVER])
                break
            else:
                stack.pop()
                known[i, state] = max(known.get((i, state), 0), frame[4])
                if stack:
                    path.pop()
                    price = cost - stack[-1][2]
                    stack[-1][4] = min(stack[-1][4], price + known[i, state])
        bound = known[0, start]
    return _NEVER, ""


@lru_cache(maxsize=1 << 15)
def whole(codes: str) -> tuple[int, str]:
    """Cheapest repair of a whole conversation."""
    return search(codes, START, (START, ASSISTANT), closing=True)


def part(codes: str) -> tuple[list[int], list[str]]:
    """Costs and edits of a part of a conversation, from each state to each state (16 of them)."""
    costs, edits = [], []
    for a in range(4):
        for b in range(4):
            meets = {
                START: a == START,
                SYSTEM: a == SYSTEM or (a == START and ("s" in codes or "S" in codes)),
            }.get(b, True)
            cost, path = search(codes, a, (b,), closing=False) if meets else (_NEVER, "")
            costs.append(cost)
            edits.append(path)
    return costs, edits


#: What is inserted after the last turn, to end in order.
_CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def chosen(costs: np.ndarray, ranks: np.ndarray) -> tuple[int, list[int]]:
    """Cost and states between parts of the cheapest repair, the least one in ASCII order.

    ``costs`` and ``ranks`` are parts x 16; ranks order the edits of a part that
    start in one state. Edits of a part never start with those of another end
    of it, so the first part that differs decides.
    """
    ahead = np.array([INSERT * len(_CLOSING[s]) for s in range(4)])
    togo = [ahead]
    for k in range(len(costs) - 1, -1, -1):
        ahead = (costs[k].reshape(4, 4) + ahead).min(axis=1)
        togo.append(ahead)
    togo = togo[::-1]
    states = [START]
    for k in range(len(costs)):
        a = states[-1]
        row = costs[k].reshape(4, 4)[a] + togo[k + 1]
        states.append(min(np.flatnonzero(row == row.min()).tolist(), key=lambda b: ranks[k][4 * a + b]))
    return int(togo[0][START]), states


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in _LEGAL for i in range(len(initials) - 1))


def _initials(codes: str) -> str:
    return "".join(_INTACT[_CODES.index(c) % 4] for c in codes)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for block, codes in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist()):
            if block == 0 and len(codes) < BLOCK:
                costs, edits = map(list, zip(whole(codes)))
                ranks: list[int] = []
            else:
                costs, edits = part(codes)
                ranks = [sorted(edits[4 * (i // 4) : 4 * (i // 4) + 4]).index(e) for i, e in enumerate(edits)]
            initials = _initials(codes)
            row = costs, ranks, edits, _illegal(initials), initials[0] + initials[-1]
            for column, value in zip(out, row):
                column.append(value)
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), *[pa.array(c, k) for c, k in zip(out, kinds)]],
            names=["conv", "block", "costs", "ranks", "edits", "illegal", "rim"],
        )


def _choose(parts: pd.DataFrame) -> pd.DataFrame:
    """Entry state, exit state and costs of the parts of one long conversation."""
    parts = parts.sort_values("block").reset_index(drop=True)
    cost, states = chosen(np.stack(parts["costs"].to_list()), np.stack(parts["ranks"].to_list()))
    rims = "".join(parts["rim"])
    between = [rims[2 * k - 1 : 2 * k + 1] not in _LEGAL for k in range(1, len(parts))]
    return pd.DataFrame(
        {
            "conv": parts["conv"],
            "block": parts["block"],
            "entry": states[:-1],
            "exit": states[1:],
            "cost": [cost, *[0] * (len(parts) - 1)],
            "between": [0, *map(int, between)],
            "closing": [*[""] * (len(parts) - 1), _CLOSING[states[-1]]],
        }
    )


def _turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, str, str, str]]:
    """(first of its conversation, conv, edit, role, text) of every edit, in order.

    Rows come sorted: the edits of a part (``edits`` not NULL) before its turns.
    """
    state, edits, at, conv, fresh = START, "", 0, None, False

    def inserts():
        nonlocal state, at
        while edits[at : at + 1] == "I":
            role = _EXPECTED[state]
            state, at = _AFTER[role], at + 1
            yield "I", _ROLE[role], ""

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "edits", "entry", "role", "text")]
        for key, found, entry, role, text in zip(*columns):
            if found is not None:
                for edit in inserts():
                    yield fresh, conv, *edit
                    fresh = False
                if entry < 0:  # the first part of a conversation
                    fresh = True
                conv, edits, at, state = key, found, 0, max(entry, START)
                continue
            for edit in inserts():
                yield fresh, conv, *edit
                fresh = False
            letter, at = edits[at], at + 1
            if letter == "R":
                role = _ROLE[_EXPECTED[state]]
            if letter != "D":
                state = SYSTEM if role[:1] == "s" else _AFTER[role[:1]]
            yield fresh, conv, letter, role, text
            fresh = False
    for edit in inserts():
        yield fresh, conv, *edit
        fresh = False


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv and the digest of its repaired turns; nothing but the digest is held of a conversation."""
    kind: list[pa.DataType] = []

    def seen():
        for batch in batches:
            kind[:] = [batch.schema.field("conv").type]
            yield batch

    convs, digests = [], []

    def ready():
        return pa.RecordBatch.from_arrays([pa.array(convs, kind[0]), pa.array(digests)], names=["conv", "digest"])

    digest, empty = None, True
    for first, conv, edit, role, text in _turns_of(seen()):
        if first:
            if digest is not None:
                digests.append(digest.hexdigest())
            if len(digests) >= 10_000:
                yield ready()
                convs, digests = [], []
            digest, empty = hashlib.sha256(), True
            convs.append(conv)
        if edit != "D":
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
    if digest is not None:
        digests.append(digest.hexdigest())
        yield ready()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per edit: conv, position, edit, role, text."""
    kind: list[pa.DataType] = []

    def seen():
        for batch in batches:
            kind[:] = [batch.schema.field("conv").type]
            yield batch

    rows: list[tuple] = []

    def ready():
        conv, *others = zip(*rows)
        types = [pa.int64(), pa.string(), pa.string(), pa.string()]
        arrays = [pa.array(conv, kind[0]), *[pa.array(c, t) for c, t in zip(others, types)]]
        return pa.RecordBatch.from_arrays(arrays, names=["conv", "position", "edit", "role", "text"])

    position = 0
    for first, conv, edit, role, text in _turns_of(seen()):
        position = 0 if first else position + 1
        rows.append((conv, position, edit, role, text))
        if len(rows) >= 5_000:
            yield ready()
            rows = []
    if rows:
        yield ready()


def _met(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which NULLs are equal."""
    named = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return left.join(named, on, how).drop(*[f"_of_{k}" for k in keys])


class Repair:
    """Conversations, their faults and their cheapest repair.

    Turns are taken in the order of their numbers (NULL first, ties by role and
    text). A turn is blank (no character but white space), a duplicate (role and
    text stood earlier in its conversation) or truncated (its last character but
    white space is none of ``.!?``); the first that holds counts. Repairs keep
    a turn (cost 0), give it the role user or assistant (2), delete it (3; blank
    and duplicate turns must go) or insert an empty user or assistant turn (2);
    truncated turns that stay cost 1. A repaired conversation is an optional
    system turn and pairs of user and assistant turns, or empty. Of the cheapest
    repairs the one whose letters (D, I, K, R) come first in ASCII order is taken.

    Turns are numbered, checked for copies and searched in blocks of ``BLOCK``,
    so that no task holds a whole conversation: blocks are searched from each
    state to each state, and what is put together per conversation are their
    costs alone. The turns themselves stream past their edits, once.

    - NULL texts and roles are one space; a NULL turn number sorts first; rows
      without a conversation id are one conversation, with the id NULL.
    - An empty role, or one that starts with another letter than s, u or a, has to be changed or deleted.
    - Repeated rows are duplicates; an empty table gives empty results.
    - Further columns are ignored, whatever their names.
    """

    def __init__(self, turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
        def given(name: str) -> Column:
            return F.col(f"`{name}`")

        rows = turns.select(
            given(conv_col).alias("conv"),
            given(turn_col).alias("turn"),
            F.coalesce(given(role_col).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(given(text_col).cast("string"), F.lit(" ")).alias("text"),
            F.lit(1).alias("one"),
        )
        numbered = running_total(rows, ["conv"], ["turn", "role", "text"], "one", "pos").drop("one")
        self._turns = staged(numbered, "turns", compression="zstd")
        self._codes = staged(self._coded(), "codes")
        self._solve()

    def _coded(self) -> DataFrame:
        """conv, turn, pos, fault and code of each turn."""
        end = F.rtrim("text", F.lit(_WHITE))
        rows = self._turns.select(
            "conv",
            "turn",
            "pos",
            "role",
            F.md5("text").alias("digest"),
            (end == "").alias("blank"),
            (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"),
        )
        again = rows.groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"), F.count("pos").alias("n"))
        again = again.filter("n > 1")
        rows = _met(rows, again, ["conv", "role", "digest"], "left")
        rows = rows.withColumn("again", F.col("pos") > F.col("first"))
        fault = (
            F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("truncated"), "truncated")
        )
        kind = F.when(fault.isNull(), 0).when(fault == "truncated", 1).otherwise(2)
        initial = F.substring("role", 1, 1)
        which = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        code = F.substr(F.lit(_CODES), kind * 4 + which + 1, F.lit(1))
        return rows.select("conv", "turn", "pos", fault.alias("fault"), code.alias("code"))

    def _solve(self) -> None:
        in_block = self._codes.groupBy("conv", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("turns")
        )
        blocks = in_block.select("conv", "block", F.array_join("turns.code", "").alias("codes"))
        kind = blocks.schema["conv"].dataType.simpleString()
        schema = f"conv {kind}, block bigint, costs array<bigint>, ranks array<bigint>, edits array<string>, illegal bigint, rim string"
        # Few bytes but much work: dealt out to as many tasks as a shuffle has.
        width = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        solved = staged(blocks.repartition(width).mapInArrow(_solve, schema), "solved")
        alone = solved.filter(F.size("costs") == 1).select(
            "conv",
            "block",
            F.lit(-1).alias("entry"),
            F.col("edits")[0].alias("edits"),
            F.col("costs")[0].alias("cost"),
            "illegal",
        )
        several = solved.filter(F.size("costs") > 1)
        schema = f"conv {kind}, block bigint, entry int, exit int, cost bigint, between bigint, closing string"
        choice = several.select("conv", "block", "costs", "ranks", "rim").groupBy("conv").applyInPandas(_choose, schema)
        picked = F.get("edits", F.col("entry") * 4 + F.col("exit"))
        joined = _met(several, choice, ["conv", "block"]).select(
            "conv",
            "block",
            F.when(F.col("block") == 0, -1).otherwise(F.col("entry")).alias("entry"),
            F.concat(picked, "closing").alias("edits"),
            "cost",
            (F.col("illegal") + F.col("between")).alias("illegal"),
        )
        self._parts = staged(alone.union(joined), "edits")

    def _stream(self) -> DataFrame:
        """Turns of a conversation in order, each block after its edits."""
        block = F.floor(F.col("pos") / BLOCK)
        edits = self._parts.select(
            "conv", "block", F.lit(-1).cast("long").alias("pos"), "edits", "entry", F.lit("").alias("role"), F.lit("").alias("text")
        )
        turns = self._turns.select(
            "conv", block.alias("block"), "pos", F.lit(None).cast("string"), F.lit(None).cast("int"), "role", "text"
        )
        return edits.union(turns).repartition("conv").sortWithinPartitions("conv", "block", "pos")

    def summary(self) -> DataFrame:
        """One row per conversation: conv, gaps, counts of faults, illegal, cost, audit (the edits), digest.

        ``gaps`` are the numbers that are missing between the first and the last
        turn, ``illegal`` the neighbours that are not system and user, user and
        assistant, or assistant and user. ``digest`` is the SHA-256 of the
        repaired turns as ``role:text``, joined by line feeds.
        """
        faults = ["blank", "duplicate", "truncated"]
        by_turn = self._codes.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in faults])
        gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        counts = by_turn.groupBy("conv").agg(
            F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in faults]
        )
        edits = self._parts.groupBy("conv").agg(
            F.sum("illegal").alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.sort_array(F.collect_list(F.struct("block", "edits")))["edits"], "").alias("audit"),
        )
        kind = self._parts.schema["conv"].dataType.simpleString()
        digests = self._stream().mapInArrow(_digests, f"conv {kind}, digest string")
        found = _met(_met(counts, edits, ["conv"]), digests, ["conv"])
        return found.select("conv", "gaps", *faults, "illegal", "cost", "audit", "digest")

    def edits(self) -> DataFrame:
        """One row per edit in order: conv, position, edit, role, text; without the D rows it is the repaired text."""
        kind = self._parts.schema["conv"].dataType.simpleString()
        schema = f"conv {kind}, position bigint, edit string, role string, text string"
        return self._stream().mapInArrow(_edited, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of conversations with faults put in by a checksum of the turn.

    Of twenty turns one is dropped, one emptied, one loses its ``.!?``, one is
    repeated and one gets the role user. NULL roles and texts become one space.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.filter("kind != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
