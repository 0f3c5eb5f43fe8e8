import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import langid
from layerloom.llm.queries import op8_language_id
from layerloom.llm.registry import table

SCHEMA = "doc_id bigint, text string, lang string"


def _texts(n, seed):
    rng = random.Random(seed)
    sounds = {"aa": ["ka", "lo", "mi"], "bb": ["stra", "öch", "ung"], "cc": ["что", "это", "ни"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(sounds))
        text = " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(rng.randint(1, 200)))
        rows.append((i, text, lang))
    return rows


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = op8_language_id(spark, sf_dir).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_learns_only_what_it_is_given(spark):
    rows = _texts(300, 1)
    docs = spark.createDataFrame(rows, SCHEMA)
    learn = docs.filter("lang <> 'cc'")
    out = langid.predict(docs, learn).collect()
    assert {r.lang_pred for r in out} == {"aa", "bb"}


def test_windows_cover_every_run_of_bytes():
    for n in [0, 1, 3, 127, 128, 129, 253, 254, 1000]:
        data = bytes(random.Random(n).choices(range(1, 256), k=n))
        seen = {bytes(w[i : i + k]) for w in langid.windows_of(data) for k in (2, 3, 4) for i in range(129 - k)}
        assert {data[i : i + k] for k in (2, 3, 4) for i in range(n - k + 1)} <= seen


def test_pair_tables_equal_plain_convolution():
    network = langid.train([(lang, text) for _, text, lang in _texts(60, 2)], steps=5)
    windows = langid.windows_of(langid._prepared("öchung что kalomi " * 30))
    embedded = network.embedding[windows]
    plain = sum(embedded[:, j : j + langid.STEP] @ network.filters[j] for j in range(4)).max(axis=1)
    assert np.allclose(langid._pooled(windows, network.byte_pairs()), plain, atol=1e-4)


def test_gradients_lower_the_error():
    texts = [(lang, text) for _, text, lang in _texts(200, 3)]
    network = langid.train(texts, steps=120)
    pairs = network.byte_pairs()
    hits = [
        network.languages[langid.probabilities(network, langid.windows_of(langid._prepared(t)), pairs).mean(0).argmax()] == lang
        for _, t, lang in _texts(100, 4)
    ]
    assert np.mean(hits) > 0.95


def test_edge_cases(spark):
    rows = _texts(120, 5) + [
        (1000, None, "aa"), (1001, "", "aa"), (1002, " 12 ²½ !?", "bb"), (1003, "kalo" * 100_000, None),
        (None, "kalomi", None), (1003, "kalo", None), (1004, "é" * 3, "bb"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit(1), "doc": F.lit(2)})
    out = langid.predict(docs, docs, with_text=True)
    assert out.select("doc.*").columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc.doc_id == 1003 or r.doc.doc_id is None:
            assert r.lang_pred == "aa"


def test_every_language_is_learnt(spark):
    """More languages than once had an output, one of them seen once, late in a long text and among repeated rows."""
    rng = random.Random(6)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    sounds = {f"l{k:02}": ["".join(rng.choices(letters, k=3)) for _ in range(6)] for k in range(80)}
    rows = []
    for lang, own in sounds.items():
        for _ in range(12 if lang != "l79" else 6):
            rows.append((len(rows), " ".join("".join(rng.choices(own, k=3)) for _ in range(60)), lang))
    rows += [(i, "12 ²½ !? " * 3, "none") for i in range(5000, 5010)]
    rows += [(6000, "1 2 3 " * 40_000 + "что это", "late")] + [(None, "7 8 9 !", "late")] * 2000
    rows += [(None, "ßöüß ßüö", "copies")] * 1000
    docs = spark.createDataFrame(rows, SCHEMA)
    sample = langid.labelled_sample(docs, "doc_id", "text", "lang")
    assert {lang for lang, _ in sample} == {*sounds, "late", "copies"}
    assert all(langid._LETTER.search(text) for _, text in sample)
    assert [text for lang, text in sample if lang == "copies"] == ["ßöüß ßüö"]
    clean = docs.filter(F.col("lang").startswith("l") & (F.col("lang") != "late"))
    out = langid.predict(clean, docs).collect()
    assert np.mean([r.doc.lang == r.lang_pred and r.score >= 0.4 for r in out]) >= 0.97


def test_sample_is_bounded_for_each_language(spark):
    docs = spark.createDataFrame([(i, f"kalo {i}", "aa" if i % 50 else "bb") for i in range(4000)], SCHEMA)
    n = Counter(lang for lang, _ in langid.labelled_sample(docs, "doc_id", "text", "lang"))
    assert 200 <= n["aa"] <= langid.DOCS_PER_LANGUAGE and n["bb"] == 80


@pytest.mark.parametrize("rows", [[], [(1, "kalo", None)]])
def test_nothing_to_learn_from(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, docs).collect()] == [("und", 0.0)] * len(rows)
