import random

import pytest

from layerloom.llm.components import connected_components
from layerloom.llm.rows import ROW, running_total, with_row_key


def _plain(edges):
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(50, i) for i in range(100)] + [(200, 201), (201, 200), (7, 7)],
        "random": [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)],
        "none": [],
    }[kind]
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == _plain(edges)


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), i, rng.randint(0, 9)) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, n bigint").repartition(5)
    found = running_total(df, ["k"], ["i"], "n", "before").collect()
    assert {(r.k, r.i): r.before for r in found} == {
        (k, i): sum(n for kk, j, n in rows if kk == k and j < i) for k, i, _ in rows
    }
    whole = running_total(df, [], ["i"], "n", "before").collect()
    assert {r.i: r.before for r in whole} == {i: sum(n for _, j, n in rows if j < i) for _, i, _ in rows}
    assert running_total(df.limit(0), ["k"], ["i"], "n", "before").collect() == []


def test_row_keys(spark):
    unique = spark.createDataFrame([(3, "x"), (1, "y")], "id bigint, text string")
    assert {(r.id, r[ROW]) for r in with_row_key(unique, "id").collect()} == {(1, 1), (3, 3)}
    mixed = spark.createDataFrame([(3, "b"), (3, "a"), (None, "c"), (1, "d"), (3, "a")], "id bigint, text string")
    rows = sorted(with_row_key(mixed, "id", ["text"]).collect(), key=lambda r: r[ROW])
    assert [(r.id, r.text) for r in rows] == [(1, "d"), (3, "a"), (3, "a"), (3, "b"), (None, "c")]
    assert len({r[ROW] for r in rows}) == 5
    names = spark.createDataFrame([("b",), ("a",)], "id string")
    assert [r.id for r in sorted(with_row_key(names, "id").collect(), key=lambda r: r[ROW])] == ["a", "b"]
