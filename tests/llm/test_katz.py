import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import katz
from layerloom.llm.queries import op2_katz
from layerloom.llm.registry import table
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, held boolean"


class Plain:
    """The model in dictionaries."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for text in texts:
            tokens = self.tokens(text)
            self.one.update(tokens)
            self.two.update(zip(["<s>", *tokens], tokens))
        self.context = Counter()
        self.after = defaultdict(list)
        for (v, w), c in self.two.items():
            self.context[v] += c
            self.after[v].append((w, c))
        self.n, self.v = sum(self.one.values()), len(self.one)
        counts = [[sum(c == r for c in x.values()) for r in range(1, 7)] for x in (self.one, self.two)]
        self.d1, self.d2 = (katz.discounts(c) for c in counts)
        kept = sum(self.d(self.d1, c) for c in self.one.values())
        self.total = self.n + (kept >= self.n)
        self.unknown = 1 - kept / self.total

    @staticmethod
    def tokens(text):
        return [*brute.words(brute.lower(text or "")), "</s>"]

    @staticmethod
    def d(factors, c):
        return c * factors[min(c, 6)]

    def alone(self, w):
        return self.d(self.d1, self.one[w]) / self.total if self.one[w] else self.unknown

    def p(self, w, v):
        if not self.context[v]:
            return self.alone(w)
        mass = sum(self.d(self.d2, c) for _, c in self.after[v])
        scale = self.context[v] + (mass >= self.context[v])
        if self.two[v, w]:
            return self.d(self.d2, self.two[v, w]) / scale
        covered = sum(self.alone(x) for x, _ in self.after[v])
        return (1 - mass / scale) / (1 - covered) * self.alone(w)

    def row(self, text):
        tokens = self.tokens(text)
        base = sum(math.log10((self.one[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in tokens)
        score = sum(math.log10(self.p(w, v)) for v, w in zip(["<s>", *tokens], tokens))
        return len(tokens), sum(self.one[w] > 0 for w in tokens), self.n, base, score


def _compare(rows, docs):
    model = Plain([t for _, t, h in docs if h is False])
    assert len(rows) == len(docs)
    expected = sorted((i if i is not None else -1, h is not False, *model.row(t)) for i, t, h in docs)
    got = sorted((r.id if r.id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    for e, g in zip(expected, got):
        assert e[:5] == g[:5]
        assert np.allclose(e[5:], g[5:], rtol=1e-9, atol=1e-9), (e, g)


def _texts(seed, n=120):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(8)]
    rows = []
    for i in range(n):
        words = [rng.choice(common) if rng.random() < 0.8 else f"r{rng.randint(0, 200)}" for _ in range(rng.randint(0, 60))]
        rows.append((i, " ".join(words).upper() if i % 3 else " ".join(words), rng.random() < 0.2))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_scores_against_plain_model(spark, monkeypatch, seed):
    monkeypatch.setattr(katz, "BLOCK_WORDS", 300)
    docs = _texts(seed)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    _compare(katz.katz_scores(df, F.col("held"), parts=5).collect(), docs)


def test_probabilities_add_up_to_one():
    docs = _texts(9)
    model = Plain([t for _, t, h in docs if not h])
    for v in ["<s>", "w1", "r5", "never", *list(model.context)[:20]]:
        # All learnt tokens, and one that stands for the class of all others.
        total = sum(model.p(w, v) for w in model.one) + model.p("never met", v)
        assert math.isclose(total, 1, abs_tol=1e-9)


def test_discounts():
    turing = katz.discounts([1000, 400, 220, 150, 110, 80])
    assert all(0 < d < 1 for d in turing[1:6]) and turing[6] == 1
    # Katz's condition: the discounts free the mass of the items that occur once.
    freed = sum(n * r * (1 - turing[r]) for r, n in enumerate([1000, 400, 220, 150, 110], 1))
    assert math.isclose(freed, 1000)
    for counts in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 9, 9, 9, 9], [0, 3, 0, 1, 0, 0]):
        assert all(0 < d < 1 for d in katz.discounts(counts)[1:6])


def test_whole_table(spark, sf_dir):
    docs = [
        (r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        for r in table(spark, sf_dir, "documents").collect()
    ]
    rows = op2_katz(spark, sf_dir).withColumnRenamed("doc_id", "id").collect()
    _compare(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge_cases(spark):
    docs = [
        (1, None, False), (2, "", False), (3, "a b a b a b a b a b a b a b", False), (4, " \n", True),
        (None, "a b c", None), (3, "b a", True), (5, "word " * 100_000, False), (6, "zzz", True),
    ]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"id": F.lit("x"), "block": F.lit(1)})
    _compare(katz.katz_scores(df, F.col("held")).collect(), docs)


def test_nothing_to_learn(spark):
    docs = [(1, "a b", True), (2, None, True)]
    rows = katz.katz_scores(spark.createDataFrame(docs, SCHEMA), F.col("held")).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in rows] == [(0, 0, 0.0)] * 2
    assert katz.katz_scores(spark.createDataFrame([], SCHEMA), F.col("held")).collect() == []


def test_tables_hold_the_counts(spark, tmp_path):
    docs = _texts(4)
    df = spark.createDataFrame(docs, SCHEMA)
    katz.katz_scores(df, F.col("held"), tables=str(tmp_path / "t"), parts=3).collect()
    model = Plain([t for _, t, h in docs if not h])
    counts = defaultdict(list)
    for r in spark.read.parquet(f"{tmp_path}/t/counts").filter("kind = 'table'").collect():
        counts[r.level] += katz._unpacked(bytes(r.data), "<i8").tolist()
    assert sorted(counts[1]) == sorted(model.one.values())
    assert sorted(counts[2]) == sorted(model.two.values())


def test_ids_of_other_types_and_a_clean_catalog(spark):
    rows = [(float(i), "a b a c") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id double, text string")
    found = katz.katz_scores(docs, F.col("doc_id") == 0.0).collect()
    assert sorted(r.id for r in found) == [0.0, 1.0, 2.0]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]
