"""Token ids of many texts, every distinct piece of which is tokenized only once.

Texts are cut before runs of white space, and for a tokenizer that keeps letters
and signs apart also where a sign follows an ASCII letter, so that a word is one
piece whatever sign stands behind it. The tokenizers used here never join bytes
across such a cut, so the ids of a text are those of its pieces one after the other.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Collection, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from layerloom.llm.words import RunHashes

#: Known pieces per Python worker; they are learnt anew beyond it.
KNOWN_PIECES = 1_000_000
#: Bytes of text that are worked on at a time, and the longest piece that is remembered.
_CHUNK_BYTES = 1 << 20
_LONGEST = 64
#: Unknown words that are tokenized in one text.
_TOGETHER = 128
_SPACES = " \t\n\v\f\r"
#: Letters that unknown words may be made of: Latin ones.
_LETTERS = string.ascii_letters + "".join(map(chr, range(0xC0, 0x250)))

# Classes of bytes: white space, and first bytes of what may ask for the text to be taken whole.
_SPACE, _SUSPECT = 1, 2
_LETTER = np.zeros(256, bool)
_LETTER[list(string.ascii_letters.encode())] = True
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(9, 14), 32]] = _SPACE
_CLASS[[0xC2, 0xE1, 0xE2, 0xE3, ord("<")]] = _SUSPECT
# White space beyond ASCII may belong to a run that the cut would split, and
# special tokens are looked for in the whole text.
_WHOLE = {chr(c).encode() for c in [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]}
_WHOLE.add(b"<|")

_BYTE_HASHES = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64)
_ANY_CASE_HASHES = _BYTE_HASHES.copy()
_ANY_CASE_HASHES[list(string.ascii_uppercase.encode())] = _BYTE_HASHES[list(string.ascii_lowercase.encode())]


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes, where each is first, and which one each of the given is.

    The lowest bits give way to the places, so that numbers alone are sorted. In
    the rare case that this leaves differing hashes out of order, they are sorted whole.
    """
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    order = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
    order.sort()
    order = (order & low).astype(np.int64)
    found = hashes[order]
    if (found[1:] < found[:-1]).any():
        return np.unique(hashes, return_index=True, return_inverse=True)
    begins = np.ones(len(hashes), bool)
    begins[1:] = found[1:] != found[:-1]
    place = np.empty(len(hashes), np.int64)
    place[order] = np.cumsum(begins) - 1
    return found[begins], order[begins], place


class PieceCache:
    """Ids of texts, as little-endian unsigned numbers of ``dtype``.

    Pieces are told apart by 64-bit hashes of their bytes. Subclasses tokenize.
    ``apart`` are ASCII signs before which a text may be cut if a letter comes
    before; with ``any_case`` pieces have the same ids in upper and lower case.
    """

    def __init__(self, size: int, whole: Collection[bytes] = (), apart: bytes = b"", any_case: bool = False):
        self.size = size
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._whole = whole
        self._apart_from_letters = np.zeros(256, bool)
        self._apart_from_letters[list(apart)] = True
        self._any_case = any_case
        self._forget()

    def _plain(self, texts: list[bytes]) -> Sequence[Sequence[int]]:
        """The ids of some texts."""
        raise NotImplementedError

    def _counted(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of some texts has, and all of them."""
        found = self._plain(texts)
        n = np.fromiter(map(len, found), np.int64, len(found))
        return n, np.fromiter(chain.from_iterable(found), self.dtype, int(n.sum()))

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)  # sorted
        self._begin = np.zeros(0, np.int64)  # of each key's ids
        self._n = np.zeros(0, np.int64)
        self._ids = np.zeros(1 << 20, self.dtype)
        self._used = 0

    def _learn(self, at: np.ndarray, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Tokenize unknown pieces; ``at`` is where their sorted keys go."""
        n, ids = self._counted(pieces)
        total = len(ids)
        if self._used + total > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(len(self._ids) + total, self.dtype)])
        self._ids[self._used : self._used + total] = ids
        begin = self._used + np.cumsum(n) - n
        self._used += total
        self._keys = np.insert(self._keys, at, keys)
        self._begin, self._n = np.insert(self._begin, at, begin), np.insert(self._n, at, n)

    def _hashed(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the bytes that pieces are told apart by."""
        if not self._any_case:
            return _BYTE_HASHES[data]
        hashes = _ANY_CASE_HASHES[data]
        # With a mark behind it, one case of a letter may be composed and the other not.
        marked = np.flatnonzero(data[1:] >= 128)
        hashes[marked] = _BYTE_HASHES[data[marked]]
        return hashes

    def _encode(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Ids of the texts that lie end to end in the data."""
        if not len(data):
            return [b""] * len(begins)
        raw = data.tobytes()
        kind = _CLASS[data]
        space = kind == _SPACE
        cut = np.zeros(len(data), bool)
        cut[1:] = space[1:] & ~space[:-1] | self._apart_from_letters[data[1:]] & _LETTER[data[:-1]]
        cut[begins[begins < ends]] = True
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], len(data))
        hashes = RunHashes(self._hashed(data))
        distinct, first, place = _distinct(hashes.of(start, stop))
        if len(self._keys) > KNOWN_PIECES:
            self._forget()
        at = np.searchsorted(self._keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self._keys)
        new[inside] = self._keys[at[inside]] != distinct[inside]
        if new.any():
            which = first[new]
            spans = zip(start[which].tolist(), stop[which].tolist())
            self._learn(at[new], distinct[new], [raw[a:b] for a, b in spans])
            at = np.searchsorted(self._keys, distinct)
        n, begin = self._n[at][place], self._begin[at][place]
        upto = np.cumsum(n)
        ids = self._ids[np.repeat(begin - (upto - n), n) + np.arange(int(upto[-1]))]
        # Ids of whole texts, from those before their first and after their last piece.
        edges = np.append(0, upto)
        low, high = edges[np.searchsorted(start, begins)], edges[np.searchsorted(start, ends)]
        out = [ids[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist())]
        uncut = self._taken_whole(raw, np.flatnonzero(kind == _SUSPECT), start, stop, begins, ends)
        for i, found in zip(uncut, self._plain([raw[begins[i] : ends[i]] for i in uncut]) if uncut else ()):
            out[i] = np.array(found, self.dtype).tobytes()
        return out

    def _taken_whole(self, raw, suspects, start, stop, begins, ends) -> list[int]:
        """Texts that must not be cut, or have pieces too long to be told apart by a hash."""
        at = [i for i in suspects.tolist() if raw[i : i + 2] in self._whole or raw[i : i + 3] in self._whole]
        at += start[stop - start > _LONGEST].tolist()
        return sorted(set((np.searchsorted(ends, np.array(at, np.int64), "right")).tolist()))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a string or binary array; NULL is like an empty text."""
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        out: list[bytes] = []
        i = 0
        while i < len(texts):
            j = max(int(np.searchsorted(offsets, offsets[i] + _CHUNK_BYTES, "right")) - 1, i + 1)
            j = min(j, len(texts))
            edges = offsets[i : j + 1] - offsets[i]
            out += self._encode(data[offsets[i] : offsets[j]], edges[:-1], edges[1:])
            i = j
        return out


class Encoder(PieceCache):
    """Ids by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self._tokenizer = Tokenizer.from_file(path)
        cuts, normal = self._tokenizer.pre_tokenizer, self._tokenizer.normalizer
        apart = "".join(p for p in string.punctuation if cuts and len(cuts.pre_tokenize_str(f"a{p}")) == 2)
        any_case = normal is not None and normal.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        added = self._tokenizer.get_added_tokens_decoder()
        plain = [(i, t.content.encode()) for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self._between = plain[0] if plain else None
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._word, self._last = self._words(size)
        super().__init__(size, _WHOLE, apart.encode(), any_case)

    def _words(self, size: int) -> tuple[re.Pattern | None, np.ndarray]:
        """What texts are one word whatever stands beside them, and which ids are the last of a word.

        Only where the tokenizer marks the last ids of words, and spaces do nothing but part words.
        """
        tokenizer, last = self._tokenizer, np.zeros(size, bool)
        vocabulary, suffix = tokenizer.get_vocab(), getattr(tokenizer.model, "end_of_word_suffix", None)
        # Every word has a last id if every byte has one.
        if not suffix or any(c + suffix not in vocabulary for c in pre_tokenizers.ByteLevel.alphabet()):
            return None, last
        last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

        def words(text: str) -> list[str]:
            normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
            return [w for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)] if tokenizer.pre_tokenizer else [normal]

        if words(" \t\n\v\f\rab \n cd") != ["ab", "cd"]:
            return None, last
        letters = [c for c in _LETTERS if len(words(f"a{c}a {c}")) == 2]
        return re.compile(f"[{_SPACES}]*[{''.join(letters)}]+") if letters else None, last

    def _plain(self, texts: list[bytes]) -> list[list[int]]:
        return self._found([t.decode("utf-8", "replace") for t in texts])

    def _found(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _counted(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words many at a time, told apart by their last ids; the others by special tokens."""
        if self._word is None:
            return self._parted(texts)
        decoded = [t.decode("utf-8", "replace") for t in texts]
        is_word = np.fromiter((m is not None for m in map(self._word.fullmatch, decoded)), bool, len(texts))
        which = np.flatnonzero(is_word)
        words = [decoded[i] for i in which.tolist()]
        found = self._found([" ".join(words[i : i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)])
        ids = np.fromiter(chain.from_iterable(found), self.dtype, sum(map(len, found)))
        stop = np.flatnonzero(self._last[ids]) + 1
        if len(stop) != len(words):  # then one of them is more than a word
            return self._parted(texts)
        rest = np.flatnonzero(~is_word)
        n = np.empty(len(texts), np.int64)
        n[which] = np.diff(stop, prepend=0)
        n[rest], others = self._parted([texts[i] for i in rest.tolist()])
        of_word = np.repeat(is_word, n)
        out = np.empty(len(of_word), self.dtype)
        out[of_word], out[~of_word] = ids, others
        return n, out

    def _parted(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All in one text, a special token between two: what lies on its sides is tokenized on its own."""
        if self._between is not None and texts:
            [ids] = self._plain([self._between[1].join(texts)])
            ids = np.array(ids, self.dtype)
            between = ids == self._between[0]
            at = np.flatnonzero(between)
            if len(at) == len(texts) - 1:  # otherwise a text has the token itself
                edges = np.concatenate([[-1], at, [len(ids)]])
                return np.diff(edges) - 1, ids[~between]
        return super()._counted(texts)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file, with what it knows."""
    return Encoder(path)
