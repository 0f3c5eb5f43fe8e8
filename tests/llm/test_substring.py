import random

from pyspark.sql import functions as F

from layerloom.llm import substring
from layerloom.llm.queries import op9_substring
from layerloom.llm.registry import table
from tests.llm import brute

SCHEMA = "doc_id bigint, text string"


def _results(df):
    return {r.doc.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    rows = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op9_substring(spark, sf_dir).collect()}
    assert rows == brute.without_repeats(docs, 20)
    assert any(r[1] for r in rows.values())


def test_few_words_many_repeats(spark):
    """A tiny vocabulary: anchors with many different stretches, repeats within a document."""
    rng = random.Random(1)
    docs = []
    for i in range(300):
        ws = [rng.choice("ab") for _ in range(rng.randint(0, 120))]
        if docs and rng.random() < 0.5:
            other = rng.choice(docs)[1].split()
            cut = rng.randint(0, len(other))
            ws[rng.randint(0, len(ws)) :] = other[cut : cut + 60]
        docs.append((i, " ".join(ws)))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, SCHEMA).repartition(7)
    for length in (3, 8, 20, 33):
        got = _results(substring.remove_repeats(df, length=length))
        assert got == brute.without_repeats(docs, length), length


def test_frequent_anchor_is_split(spark, monkeypatch):
    """A phrase in every document among different neighbours: its rows meet the anchor in several tasks."""
    rng = random.Random(2)
    phrase = [f"common3-{i}" for i in range(16)]  # holds the smallest seed of most windows around it
    docs = []
    for i in range(3000):
        ws = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        ws[20:20] = phrase
        docs.append((i, " ".join(ws)))
    docs += [(5000 + i, docs[i][1]) for i in range(20)]
    settings = {
        "spark.sql.shuffle.partitions": "31",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    plans = {}
    whole = substring.staged

    def seen(df, label):
        if label == "shared":
            df.collect()
            plans["final"] = df._jdf.queryExecution().executedPlan().toString()
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return whole(df, label)

    monkeypatch.setattr(substring, "staged", seen)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = _results(substring.remove_repeats(spark.createDataFrame(docs, SCHEMA).repartition(9)))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == brute.without_repeats(docs, 20)
    assert not [label for label, plan in plans.items() if "Window" in plan]
    assert "skewed" in plans["final"]


def test_edge_cases(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "short"), (5, passage), (6, f"before {passage}\nafter  all"),
        (7, "short"), (8, " ".join(["z"] * 300_000)),
    ]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"runs": F.lit(1), "_row": F.lit("x")})
    out = substring.remove_repeats(df)
    assert out.columns == ["doc", "n_words", "n_removed", "kept_sha256", "text"]
    assert out.select("doc.*").columns == ["doc_id", "runs", "_row"]
    assert _results(out) == brute.without_repeats(docs, 20)
    texts = {r.doc.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[3] == " \n" and texts[5] == passage
    assert texts[6] == "before after all"


def test_repeated_and_missing_ids(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [(None, passage), (2, passage), (2, passage), (2, "a " + passage), (None, "x")]
    rows = substring.remove_repeats(spark.createDataFrame(docs, SCHEMA)).collect()
    got = sorted((r.doc.doc_id or 0, r.n_words, r.n_removed) for r in rows)
    # Of the rows with id 2 the first by text keeps the passage.
    assert got == [(0, 1, 0), (0, 30, 30), (2, 30, 30), (2, 30, 30), (2, 31, 0)]


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
