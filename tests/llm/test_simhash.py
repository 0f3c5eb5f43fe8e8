import random

import pytest
from pyspark.sql import functions as F

from layerloom.llm import simhash
from layerloom.llm.queries import op7_simhash
from layerloom.llm.registry import table
from tests.llm import brute

SCHEMA = "doc_id bigint, text string"


@pytest.mark.parametrize("distance", range(8))
def test_all_pairs_within_the_distance_are_found(spark, distance):
    rng = random.Random(distance)
    prints = set()
    for _ in range(40):
        center = rng.getrandbits(64)
        prints.add(center)
        for _ in range(6):
            near = center
            for bit in rng.sample(range(64), rng.randint(1, distance + 3)):
                near ^= 1 << bit
            prints.add(near)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "f bigint"), distance)
    mask = (1 << 64) - 1
    expected = {
        (a, b)
        for a in signed
        for b in signed
        if a < b and ((a ^ b) & mask).bit_count() <= distance
    }
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == expected
    assert len(rows) == len(expected)


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, brute.simhash(r.text)) for r in table(spark, sf_dir, "documents").collect()]
    component = brute.components(docs, 3)
    expected = {(i, f"{f:016x}", component[i]) for i, f in docs}
    rows = {(r.doc_id, r.fingerprint, r.component_id) for r in op7_simhash(spark, sf_dir).collect()}
    assert rows == expected
    assert any(i != c for i, _, c in rows)


def test_edge_cases(spark):
    long = "Lorem ipsum " * 70_000
    docs = [
        (5, None), (4, ""), (9, " \t"), (7, "one two"), (3, "ONE\ttwo"), (3, "one two"),
        (None, "one two"), (8, long), (6, long + "\n"), (None, "all alone here and gone"),
    ]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("component", F.lit("clash"))
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == len(docs)
    got = sorted((r.id or 0, r.component or 0) for r in rows)
    assert got == [(0, 0), (0, 3), (3, 3), (3, 3), (4, 4), (5, 4), (6, 6), (7, 3), (8, 6), (9, 4)]
    kept = simhash.without_near_duplicates(df.withColumn("_row", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "component", "_row"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 3), (False, 4), (False, 6), (True, 0)
    ]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.without_near_duplicates(empty).collect() == []
