"""Plain single-machine forms of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def simhash(text: str | None, shingle: int = 3) -> int:
    ws = words(lower(text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + shingle]) for i in range(max(len(ws) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[tuple[int, int]], distance: int) -> dict[int, int]:
    """Smallest reachable id of each (id, fingerprint)."""
    parent = {i: i for i, _ in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, f) in enumerate(prints):
        for j, g in prints[:n]:
            if (f ^ g).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i, _ in prints}


def without_repeats(docs: list[tuple[int, str | None]], length: int) -> dict[int, tuple[int, int, str]]:
    """id -> words, removed words, digest of the kept words joined by a space."""
    first: dict[tuple, tuple[int, int]] = {}
    texts = {i: words(t) for i, t in docs}
    for i in sorted(texts):
        ws = texts[i]
        for s in range(len(ws) - length + 1):
            first.setdefault(tuple(ws[s : s + length]), (i, s))
    out = {}
    for i, ws in texts.items():
        gone = set()
        for s in range(len(ws) - length + 1):
            if first[tuple(ws[s : s + length])] != (i, s):
                gone.update(range(s, s + length))
        kept = " ".join(w for n, w in enumerate(ws) if n not in gone)
        out[i] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
