"""Overlapping documents against all pairs of plain sets."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from layerloom.llm import parity
from layerloom.llm.queries import op13_parity
from layerloom.llm.registry import table
from tests.llm import brute

SCHEMA = "doc_id bigint, text string"


def _set(text, shingle=4):
    ws = brute.words(brute.lower(text or ""))
    if not ws:
        return frozenset()
    return frozenset(" ".join(ws[i : i + shingle]) for i in range(max(len(ws) - shingle + 1, 1)))


def _brute(docs, percent=85, shingle=4):
    """id -> (set size, component), comparing all sets of similar sizes that share a shingle."""
    sets = {i: _set(t, shingle) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    for i, s in sets.items():
        met = {}
        for x in s:
            for j in by_shingle[x]:
                if j < i:
                    met[j] = met.get(j, 0) + 1
        for j, both in met.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def _found(df, **kw):
    rows = parity.overlapping(df, **kw).collect()
    return {r.id: (r.n, r.component) for r in rows}, len(rows)


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    expected = _brute(docs)
    rows = op13_parity(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert len(rows) == len(docs)
    assert any(c != i for i, (_, c) in expected.items())


@pytest.mark.parametrize("percent", [85, 60])
def test_edited_copies(spark, percent):
    """Copies with more and more edits lie on both sides of the threshold; one passage stands in a third of the rows."""
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    docs = []
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 8, 13, 30, 80, 200, 600]))
        if rng.random() < 0.33:
            words = words + passage
        docs.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 4, 12])):
            edited = list(words)
            for _ in range(rng.randint(0, max(len(words) // 15, 1))):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            cut = rng.choice([len(edited), len(edited) * 9 // 10 or 1])
            docs.append(" ".join(edited[:cut]).title() if rng.random() < 0.2 else "  ".join(edited[:cut]))
    rng.shuffle(docs)
    docs = list(enumerate(docs, 1))
    found, n = _found(spark.createDataFrame(docs, SCHEMA), percent=percent)
    assert found == _brute(docs, percent) and n == len(docs)


def test_sketches_find_every_pair():
    """Linked sets share a key in every scheme that is meant to find them."""
    rng = np.random.default_rng(2)
    bands = parity.Bands(85)
    for _ in range(400):
        n = int(rng.integers(7, 900))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        m = int(rng.integers(max(-(-85 * len(x) // 100), 1), len(x) + 1))
        y = x[:m].copy()
        extra = 0  # as many shingles of its own as a link allows
        while 100 * m >= 85 * (len(x) + extra + 1):
            extra += 1
        y = np.concatenate([y, rng.integers(0, 1 << 63, int(rng.integers(0, extra + 1))).astype(np.uint64)])
        both = set(bands.schemes(len(x))) & set(bands.schemes(len(y)))
        larger = bands.of(max(len(x), len(y)))
        if bands.limit(larger):
            assert larger in both
            keys = [set(parity.strongest(s, larger, bands.limit(larger)).tolist()) for s in (x, y)]
            assert len(keys[0] & keys[1]) >= bands.agreeing(max(len(x), len(y)))
            apart = np.bitwise_count(parity._short_sketch(x).view(np.uint64) ^ parity._short_sketch(y).view(np.uint64)).sum()
            assert apart <= len(np.setxor1d(x, y)) <= parity.differences(85, len(x) + len(y))


def test_sets_without_a_common_shingle_share_no_key():
    """However many sets there are, small segments do not agree by chance."""
    rng = np.random.default_rng(3)
    bands = parity.Bands(85)
    for size in (100, 400):
        scheme = bands.of(size)
        top = bands.start(scheme + 1) - 1
        keys = [parity.strongest(np.unique(rng.integers(0, 1 << 63, top).astype(np.uint64)), scheme, bands.limit(scheme)) for _ in range(2000)]
        assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))


def test_edge_cases(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A "), (6, "a b c"), (7, "a b c d"), (8, long), (9, long + " end"),
        (10, "É x y z"), (11, "é x y z"), (None, "a"), (7, "a b c d"), (None, None), (12, "solo words only here now"),
        (None, "no other row has this text"),
    ]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"n": F.lit(1), "row": F.lit("x"), "node": F.lit(2)})
    rows = sorted(((r.id is None, r.id or 0, r.n, r.component is None, r.component or 0) for r in parity.overlapping(df).collect()))
    expected = [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (7, 1, 7), (8, 29_997, 8), (9, 29_998, 8),
        (10, 1, 10), (11, 1, 11), (12, 2, 12), (None, 0, None), (None, 1, 4), (None, 3, None),
    ]
    assert rows == sorted((i is None, i or 0, n, c is None, c or 0) for i, n, c in expected)
    assert parity.overlapping(spark.createDataFrame([], SCHEMA)).collect() == []


def test_buckets_across_batches():
    """However rows are cut into batches, keys with several nodes come out with their first."""
    rng = random.Random(6)
    for _ in range(200):
        rows = sorted((rng.randint(0, 6), rng.randint(0, 99)) for _ in range(rng.randint(0, 15)))
        by_key = {}
        for k, v in rows:
            by_key.setdefault(k, []).append(v)
        expected = [(k, v, vs[0]) for k, vs in by_key.items() if len(vs) > 1 for v in vs]
        batches, i = [], 0
        while i < len(rows):
            n = rng.randint(0, 4)
            part = rows[i : i + n]
            batches.append(pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in part], pa.int64()), "node": pa.array([v for _, v in part], pa.int64())}))
            i += n
        found = [tuple(r.values()) for b in parity._buckets(iter(batches)) for r in b.to_pylist()]
        assert found == expected
