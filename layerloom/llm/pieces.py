"""SentencePiece ids of texts by matching all pieces against a suffix array.

The model is a BPE one: of the neighbours whose concatenation is a piece, those
with the best score are merged first, the leftmost if several are equal. The
result is the one path of pieces over a text in which every two neighbours would
stay apart if they were encoded alone. So pieces are found as edges between
positions, and a path is relaxed from left to right: an edge extends the one
path that ends where it starts if its piece stays apart from the last one.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.tokens import PieceCache

SPACE = "▁"  # stands for a space
_ROWS = 1_000  # documents whose ids are held at a time
_MATCHED = 1 << 14  # units that are indexed at a time


class PieceModel:
    """A model file taken apart into what matching and merging need.

    Symbols are the pieces, numbered by the order in which merges make them, and
    after them one symbol for every character that is no piece.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        plain = sorted(set(range(n)) - set(special) - set(self.byte_ids.values()), key=lambda i: (-model.get_score(i), i))
        self.ids = np.array(plain, np.int64)
        self.pieces = [model.id_to_piece(i) for i in plain]
        self.longest = max(map(len, self.pieces), default=1)
        self._number = {p: k for k, p in enumerate(self.pieces)}
        self.letters = sorted({c for p in self.pieces for c in p})
        self._place = {c: k for k, c in enumerate(self.letters)}
        single = [self._symbol(c) for c in self.letters]
        self.symbol_of_code = np.array([-1, *single], np.int64)  # codes of letters start at 1
        self.cuts_spaces = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self._splits()
        self.bytes_of = [b""] * n
        for i in range(n):
            if i in special:
                self.bytes_of[i] = " ⁇ ".encode() if i == self.unknown else b""
        for i, p in zip(plain, self.pieces):
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([b])

    def apart(self) -> bytes:
        """ASCII signs that stand behind an ASCII letter in no piece, so that no merge joins the two."""
        neighbours = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        joined = {pair[1] for pair in neighbours if pair[0] in string.ascii_letters}
        return "".join(c for c in string.punctuation if c not in joined).encode()

    def _splits(self) -> None:
        """How pieces come about: which pairs make a piece, and the last merge of each piece."""
        base = len(self.pieces)
        left, right, made = [], [], []
        for k, p in enumerate(self.pieces):
            for cut in range(1, len(p)):
                a, b = self._symbol(p[:cut]), self._symbol(p[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(k)
        self.size = base + len(self.letters) + 1
        key = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        order = np.argsort(key)
        self._pair, self._made = key[order], np.array(made, np.int64)[order]
        # A symbol's last merge; single characters, and pieces that no merges lead to, are their own.
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        self.whole = np.ones(self.size, bool)
        by_text = dict(zip(zip(left, right), made))
        for k, p in enumerate(self.pieces):
            if len(p) > 1:
                parts = self._merged([self._symbol(c) for c in p], by_text)
                if parts is None:
                    self.whole[k] = False
                else:
                    self.left[k], self.right[k] = parts
        own = np.arange(self.size)
        #: Order of the merge that makes a symbol; -1 if none does.
        self.rank = np.where(self.left == own, -1, own)

    def _symbol(self, text: str) -> int | None:
        k = self._number.get(text)
        if k is None and text in self._place:
            return len(self.pieces) + self._place[text]
        return k

    @staticmethod
    def _merged(symbols: list[int], made: dict[tuple[int, int], int]) -> tuple[int, int] | None:
        """Merge to the end; the two parts of the last merge, or None if more than one symbol is left."""
        last = None
        while len(symbols) > 1:
            pairs = [(made[ab], i) for i, ab in enumerate(zip(symbols, symbols[1:])) if ab in made]
            if not pairs:
                return None
            k, i = min(pairs)
            last = (symbols[i], symbols[i + 1])
            symbols[i : i + 2] = [k]
        return last

    def _makes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair makes; a large number if none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._pair, key), len(self._pair) - 1)
        return np.where(self._pair[at] == key, self._made[at], np.iinfo(np.int64).max)

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pairs of symbols are left as they are if they are encoded together.

        Both are taken back merge by merge, the later merge first. If at some
        stage the symbols that face each other would merge before the merge that
        was last taken back, the pair does not come about.
        """
        ok = np.ones(len(a), bool)
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        todo = np.arange(len(a))
        rank = self.rank
        while len(todo):
            x, y = a[todo], b[todo]
            clash = self._makes(x, y) < limit[todo]
            ok[todo[clash]] = False
            todo, x, y = todo[~clash], x[~clash], y[~clash]
            # Merges on the left come first among equals, so a right one is passed by an equal merge.
            back = rank[x] > rank[y]
            single = (rank[x] < 0) & (rank[y] < 0)
            limit[todo] = np.where(back, rank[x], rank[y] + 1)
            a[todo] = np.where(back, self.right[x], x)
            b[todo] = np.where(back, y, self.left[y])
            todo = todo[~single]
        return ok


def _packed(letters: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Numbers made of ``width`` neighbouring letters, the first one in the highest bits."""
    n = letters.shape[-1] - width + 1
    out = np.zeros((*letters.shape[:-1], n), np.int64)
    for k in range(width):
        out = out << bits | letters[..., k : k + n]
    return out


def _ranges(codes: np.ndarray, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of the codes to the depth of the pieces, and the range of it that starts with each piece."""
    n, depth = len(codes), pieces.shape[1]
    low, high = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    # Letters that are there are numbered anew, so that many of them fit into a number.
    there = np.zeros(max(int(codes.max(initial=0)), int(pieces.max(initial=0))) + 1, bool)
    there[codes] = there[0] = True
    number = np.cumsum(there) - 1
    some = np.flatnonzero(there[pieces].all(axis=1))  # the others are nowhere
    bits = max(int(number[-1]).bit_length(), 1)
    width = 63 // bits
    levels = -(-depth // width)
    padded = np.zeros(n + levels * width, np.int64)
    padded[:n] = number[codes]
    chunks, chunk = np.unique(_packed(padded, width, bits)[: n + (levels - 1) * width], return_inverse=True)
    wanted = np.zeros((len(some), levels * width), np.int64)
    wanted[:, :depth] = number[pieces[some]]
    lengths = lengths[some]
    rank, at = chunk[:n], np.zeros(0, np.int64)  # ranks of the first letters, and the rank that a piece has up to here
    for level in range(levels):
        letters = wanted[:, level * width : (level + 1) * width]
        inside = np.arange(level * width, (level + 1) * width) < lengths[:, None]
        # The least and the greatest letters that go on like the piece.
        least = _packed(letters, width, bits)[:, 0]
        greatest = _packed(np.where(inside, letters, (1 << bits) - 1), width, bits)[:, 0]
        first, last = np.searchsorted(chunks, least, "left"), np.searchsorted(chunks, greatest, "right")
        if level:
            ahead = chunk[level * width : level * width + n]
            ranks, rank = np.unique(rank * (len(chunks) + 1) + ahead, return_inverse=True)
            first = np.searchsorted(ranks, at * (len(chunks) + 1) + first)
            last = np.searchsorted(ranks, at * (len(chunks) + 1) + last)
        before = np.append(0, np.cumsum(np.bincount(rank, minlength=len(chunks))))
        ends = lengths <= (level + 1) * width
        low[some[ends]], high[some[ends]] = before[first[ends]], before[last[ends]]
        more = ~ends & (first < last)
        some, wanted, lengths, at = some[more], wanted[more], lengths[more], first[more]
    return np.argsort(rank, kind="stable"), low, high


class PieceEncoder(PieceCache):
    """Ids of texts; distinct pieces of text are matched and relaxed once."""

    def __init__(self, path: str):
        self.model = m = PieceModel(path)
        if not m.cuts_spaces:
            raise ValueError("pieces with a space inside are not supported")
        # The sign for a space may stand in a text and belong to a run of spaces.
        super().__init__(len(m.bytes_of), {SPACE.encode()}, m.apart())
        self._code = {c: i + 1 for i, c in enumerate(m.letters)}  # 0 ends a unit
        self._code_of_point = np.zeros(ord(m.letters[-1]) + 1 if m.letters else 1, np.int64)
        for c, i in self._code.items():
            self._code_of_point[ord(c)] = i
        table = np.zeros((len(m.pieces), m.longest), np.int64)
        for k, p in enumerate(m.pieces):
            table[k, : len(p)] = [self._code[c] for c in p]
        self._table, self._lengths = table, np.array([len(p) for p in m.pieces], np.int64)
        # Units end before a run of spaces and at characters that are in no piece.
        inside = "".join(map(re.escape, set(m.letters) - {SPACE}))
        word = f"[{inside}]+" if inside else "(?!)"
        self._units = re.compile(f"{SPACE}*{word}|{SPACE}+|[^{inside}{SPACE}]")
        self._apart: dict[str, np.ndarray] = {"key": np.zeros(0, np.int64), "ok": np.zeros(0, bool)}

    def _fallback(self, char: str) -> list[int]:
        data = char.encode("utf-8", "replace")
        if all(b in self.model.byte_ids for b in data):
            return [self.model.byte_ids[b] for b in data]
        return [self.model.unknown]

    def _stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``stay_apart`` with what was found before."""
        key = a * self.model.size + b
        distinct, first, place = np.unique(key, return_index=True, return_inverse=True)
        known, ok = self._apart["key"], self._apart["ok"]
        at = np.searchsorted(known, distinct)
        inside = at < len(known)
        new = np.ones(len(distinct), bool)
        new[inside] = known[at[inside]] != distinct[inside]
        if new.any():
            found = self.model.stay_apart(a[first[new]], b[first[new]])
            known, ok = np.insert(known, at[new], distinct[new]), np.insert(ok, at[new], found)
            self._apart = {"key": known, "ok": ok}
            at = np.searchsorted(known, distinct)
        return ok[at][place]

    def _match(self, units: list[str]) -> list[list[int]]:
        """Ids of units made of letters of the model."""
        m = self.model
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        points = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        codes = self._code_of_point[points]
        # Every unit is closed by a 0, which no piece holds.
        unit = np.repeat(np.arange(len(units)), sizes)
        text = np.zeros(len(codes) + len(units), np.int64)
        place = np.arange(len(codes)) + unit
        text[place] = codes
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        suffixes, low, high = _ranges(text, self._table, self._lengths)
        used = np.flatnonzero(m.whole[: len(m.pieces)] & (high > low))
        n = (high - low)[used]
        piece = np.repeat(used, n)
        at = suffixes[np.repeat(low[used] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        # Characters that are no pieces are edges too.
        single = m.symbol_of_code
        lone = np.flatnonzero(single[codes] >= len(m.pieces))
        start = np.concatenate([at, place[lone]])
        symbol = np.concatenate([piece, single[codes[lone]]])
        stop = start + np.concatenate([self._lengths[piece], np.ones(len(lone), np.int64)])
        unit_at = np.searchsorted(begin, start, "right") - 1
        stop_in = stop - begin[unit_at]
        # Small numbers are sorted by their digits.
        order = np.argsort(stop_in.astype(np.uint16) if stop_in.max() < 1 << 16 else stop_in, kind="stable")
        start, stop, symbol, stop_in = start[order], stop[order], symbol[order], stop_in[order]
        unit_first = begin[unit_at][order] == start
        last = np.full(len(text) + 1, -1, np.int64)  # symbol of the path that ends here
        came = np.full(len(text) + 1, -1, np.int64)
        cuts = np.flatnonzero(np.diff(stop_in, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(stop_in)]):
            before = last[start[a:b]]
            fits = unit_first[a:b].copy()
            inner = np.flatnonzero(~fits & (before >= 0))
            fits[inner] = self._stay_apart(before[inner], symbol[a:b][inner])
            take = np.flatnonzero(fits) + a
            last[stop[take]], came[stop[take]] = symbol[take], start[take]
        return self._paths(units, begin, sizes, last, came)

    def _paths(self, units, begin, sizes, last, came) -> list[list[int]]:
        """Follow the paths back from the ends of all units at once."""
        m = self.model
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(units), np.int64)
        which, at = np.arange(len(units)), begin + sizes
        while len(which):
            steps.append((which, last[at]))
            count[which] += 1
            at = came[at]
            more = at > begin[which]
            which, at = which[more], at[more]
        ends = np.cumsum(count)
        symbols = np.empty(int(ends[-1]), np.int64)
        for k, (which, symbol) in enumerate(steps):
            symbols[ends[which] - 1 - k] = symbol
        lone = symbols >= len(m.pieces)  # letters of pieces that are no pieces themselves
        ids = m.ids[np.where(lone, 0, symbols)].tolist()
        edges = [0, *ends.tolist()]
        out = [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]
        for u in np.unique(np.searchsorted(ends, np.flatnonzero(lone), "right")).tolist():
            out[u] = []
            for s in symbols[edges[u] : edges[u + 1]].tolist():
                out[u] += [int(m.ids[s])] if s < len(m.pieces) else self._fallback(m.letters[s - len(m.pieces)])
        return out

    def _plain(self, texts: list[bytes]) -> list[list[int]]:
        units = [self._units.findall(t.decode("utf-8", "replace").replace(" ", SPACE)) for t in texts]
        distinct = sorted(set().union(*units))
        plain = [u for u in distinct if u[0] in self._code]
        known: dict[str, list[int]] = {}
        for i in range(0, len(plain), _MATCHED):
            some = plain[i : i + _MATCHED]
            known.update(zip(some, self._match(some)))
        known.update((u, self._fallback(u)) for u in distinct if u[0] not in self._code)
        return [known[us[0]] if len(us) == 1 else list(chain.from_iterable(known[u] for u in us)) for us in units]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; the model puts a space before a text that is not empty."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        spaced = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
        return super().encode(pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, spaced))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; one leading space is the model's own."""
        data = b"".join(map(self.model.bytes_of.__getitem__, ids.tolist()))
        return data.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=1)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_pieces(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", *, carried: Sequence[str] = ()
) -> DataFrame:
    """(id, n_pieces, ids_crc32, ids) of every document; ids are little-endian u32.

    - NULL and empty texts have no pieces.
    - Characters that are in no piece become their bytes, or the unknown piece.
    - Repeated rows and ids are encoded one by one; an empty table gives an empty
      result; further columns are ignored, but for ``carried`` ones, which follow the others.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                ids = [np.frombuffer(x, enc.dtype).astype("<u4").tobytes() for x in enc.encode(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        *part.columns[2:],
                    ],
                    names=["id", "n_pieces", "ids_crc32", "ids", *carried],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carried)
    (_, kind), _, *others = rows.dtypes
    schema = [f"id {kind}", "n_pieces bigint", "ids_crc32 bigint", "ids binary", *[f"`{c}` {t}" for c, t in others]]
    return rows.mapInArrow(kernel, ", ".join(schema))


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """Add the text of each row's ``ids``; NULL ids have a NULL text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                ids = part.column("ids").to_pylist()
                texts = [None if x is None else enc.decode(np.frombuffer(x, "<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"]
                )

    kind = ", ".join(f"{c} {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(kernel, f"{kind}, text string")
