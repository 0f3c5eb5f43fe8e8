import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import forest
from layerloom.llm.queries import op3_forest
from layerloom.llm.registry import table

SCHEMA = "vec_id bigint, embedding array<float>"


def _brute(rows, is_query, k):
    """Sorted (score, id) lists of the k nearest, with scores in double precision."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    lengths = np.sqrt((x * x).sum(axis=1))
    out = {}
    for n, i in enumerate(ids.tolist()):
        if is_query(i):
            scores = (x * x[n]).sum(axis=1) / (lengths * lengths[n])
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def _recall(found, expected):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in near}) for q, near in expected.items())
    return hits / sum(len(near) for near in expected.values())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_on_the_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    expected = _brute(rows, lambda i: i % 50 == 0, 5)
    found = _found(op3_forest(spark, folder))
    assert found.keys() == expected.keys()
    assert all(len(v) == 5 for v in found.values())
    assert _recall(found, expected) >= 0.9
    exact = {q: dict(v) for q, v in _brute(rows, lambda i: i % 50 == 0, len(rows)).items()}
    assert all(math.isclose(s, exact[q][i], rel_tol=1e-12) for q, v in found.items() for i, s in v)


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 100)
    monkeypatch.setattr(forest, "QUERY_ROWS", 7)
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((40, 16))
    rows = [(i, (centers[i % 40] + 0.1 * rng.standard_normal(16)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = _found(forest.nearest(df, F.col("vec_id") % 30 == 0, k=5))
    assert _recall(found, _brute(rows, lambda i: i % 30 == 0, 5)) >= 0.95


def test_probing_everything_is_exact_with_copies_and_ties(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(400)]
    rows = [(i, v) for i, v in rows if any(v)]
    found = _found(forest.nearest(spark.createDataFrame(rows, SCHEMA), F.lit(True), k=4, probed=1.0, trees=2))
    expected = _brute(rows, lambda i: True, 4)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in expected.items()}


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [None, 1.0]), (7, []), (None, [1.0, 0.0]), (8, [-1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]),
        (50, [1.0, 0.0, 0.0]), (100, [0.0, 0.0]), (150, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "vector": F.lit(1), "size": F.lit(2)})
    found = _found(forest.nearest(df, F.col("vec_id") % 50 == 0, k=5))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {0: [8, 8, 1, 8]}
    assert found[0][3][1] == -1.0


def test_rows_that_share_an_id_and_vectors_of_any_size(spark):
    """A query's own row takes no part, another one with its id does; squares may overflow or vanish."""
    rows = [(1, [1e200, 0.0]), (1, [1e-200, 0.0]), (2, [1e200, 1e200]), (3, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = forest.nearest(df, F.col("vec_id") == 1, k=3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == sorted([(1, 1, 1), (1, 2, 2), (1, 3, 3)] * 2)
    assert all(abs(r.score - {1: 1.0, 2: 0.5**0.5, 3: 0.0}[r.vec_id]) < 1e-15 for r in found)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert forest.nearest(empty, F.lit(True)).collect() == []
    one = spark.createDataFrame([(1, [1.0])], SCHEMA)
    assert forest.nearest(one, F.lit(False)).collect() == []
    assert forest.nearest(one, F.lit(True)).collect() == []
