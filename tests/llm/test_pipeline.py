"""The pipeline's stages on documents with planted cases, and run() on a whole table."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from layerloom.llm.registry import table
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STAGES = dict(corpus_pipeline.STAGES)


def _prose(rng, n, sounds):
    return " ".join("".join(rng.choices(sounds, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    sounds = {"aa": ["ka", "lo", "mi", "ter"], "bb": ["stra", "öch", "ung", "iß"]}
    rows = []
    for i in range(400):
        lang = rng.choice(sorted(sounds))
        rows.append([i, _prose(rng, rng.randint(60, 200), sounds[lang]), lang, f"s{i % 3}"])
    passage = _prose(rng, 60, sounds["aa"])
    rows.append([1000, rows[5][1], rows[5][2], "s0"])  # an exact copy
    rows.append([1001, rows[6][1] + " mi", rows[6][2], "s0"])  # a near copy
    for i in (1002, 1003):  # a passage in two documents
        rows.append([i, f"{_prose(rng, 80, sounds['aa'])} {passage} {_prose(rng, 80, sounds['aa'])}", "aa", "s1"])
    rows.append([1004, "12 34 !? 56", "aa", "s1"])  # no letter
    rows.append([1005, "# $ % " * 60 + _prose(rng, 40, sounds["bb"]), "bb", "s2"])  # symbols
    rows.append([1006, None, None, None])
    rows.append([None, _prose(rng, 90, sounds["aa"]), "aa", None])
    rows = [(*r, len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


def _ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay_and_decisions_take_effect(spark, docs):
    before = _ids(docs)
    found = STAGES["language_id"](spark, docs, "")
    assert found.columns == docs.columns
    assert before - _ids(found) == {1004, 1006}
    labels = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.lang == labels[r.doc_id] for r in found.collect() if r.doc_id != 1005)

    sound = STAGES["quality"](spark, docs, "")
    assert sound.columns == docs.columns
    assert before - _ids(sound) == {1004, 1005, 1006}

    one = STAGES["near_duplicates"](spark, docs, "")
    assert one.columns == docs.columns
    prints = [(r.doc_id if r.doc_id is not None else 10**9, brute.simhash(r.text)) for r in docs.collect()]
    later = {i for i, c in brute.components(prints, 3).items() if i != c}
    assert 1000 in later and before - _ids(one) == later

    cut = STAGES["substrings"](spark, docs, "")
    assert cut.columns == docs.columns
    assert _ids(cut) == before
    old = {r.doc_id: r.text for r in docs.collect()}
    new = {r.doc_id: r for r in cut.collect()}
    expected = brute.without_repeats([(i if i is not None else 10**9, t) for i, t in old.items()], 20)
    for i, r in new.items():
        n, removed, _ = expected[i if i is not None else 10**9]
        assert len(brute.words(r.text)) == n - removed
        assert r.n_chars == (None if r.text is None else len(r.text))
        if not removed:
            assert r.text == old[i]
    assert len(brute.words(new[1003].text)) == 160


def test_run_on_a_whole_table(spark, sf_dir):
    pieces = driver.queries()["pipeline"](spark, sf_dir).collect()
    docs = {r.doc_id: r for r in table(spark, sf_dir, "documents").collect()}
    kept = {r.doc_id for r in pieces}
    assert kept <= docs.keys()
    prints = [(i, brute.simhash(docs[i].text)) for i in sorted(kept)]
    assert all(i == c for i, c in brute.components(prints, 3).items())
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    sound = {i for i, r in docs.items() if labels.get(i) == 1 and len(brute.words(r.text)) >= 20}
    firsts = brute.components([(i, brute.simhash(docs[i].text)) for i in sorted(docs)], 3)
    assert len([i for i in sound if firsts[i] == i and i not in kept]) <= 0.02 * len(sound)
    assert len([i for i in kept if labels.get(i) == 0]) <= 0.2 * len([i for i in labels if labels[i] == 0])
    sizes = {}
    for r in pieces:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert all(sizes[k] == 1024 for k in range(len(sizes) - 1))


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA).withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == []
        assert name == "packing" or out.columns == docs.columns
