"""Words of UTF-8 texts, and 64-bit hashes of runs of words.

A word is a run of bytes other than space and \\x09-\\x0D, which is what
``bytes.split`` without an argument finds.
"""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# An odd number, so that its powers have inverses modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One unsigned 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Powers of each base as far as they were asked for; those of longer sequences are not kept.
_KEPT: dict[int, np.ndarray] = {}
_MOST_KEPT = (1 << 20) + 1


def _powers(base: int, n: int) -> np.ndarray:
    out = _KEPT.get(base)
    if out is None or len(out) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        out = np.multiply.accumulate(out)
        if n <= _MOST_KEPT:
            _KEPT[base] = out
    return out[:n]


class RunHashes:
    """Hashes of any run of a sequence, from one pass over it.

    ``of(a, b)`` hashes the words from ``a`` up to ``b`` (arrays are allowed).
    Equal runs have equal hashes wherever they stand.
    """

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        with np.errstate(over="ignore"):
            sums = np.zeros(n, np.uint64)
            np.cumsum(hashes * _powers(_BASE, n)[:-1], out=sums[1:])
            self._sums, self._back = sums, _powers(_INVERSE, n)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self._sums[b] - self._sums[a]) * self._back[a])
