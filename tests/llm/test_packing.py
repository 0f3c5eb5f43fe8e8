import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerloom.llm import packing
from layerloom.llm.queries import op1_packing
from layerloom.llm.registry import table
from layerloom.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, source string"


def _ids(texts, end=0):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, end] for e in found]


def _check(rows, ids, window):
    """Every id lies in exactly one piece, and sequences have no gaps."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length > 0 and len(part) == r.length
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        of_doc[r.doc_id].append((r.start, r.length))
        of_sequence[r.sequence_id].append((r.offset, r.length))
    assert of_doc.keys() == ids.keys()
    for doc, parts in of_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc])
    sizes = []
    for k in range(len(of_sequence)):
        at = 0
        for offset, length in sorted(of_sequence[k]):
            assert offset == at
            at += length
        assert at <= window
        sizes.append(at)
    assert all(s == window for s in sizes[:-1])


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").collect()
    ids = dict(zip([r.doc_id for r in docs], _ids([r.text for r in docs])))
    rows = op1_packing(spark, sf_dir).collect()
    _check(rows, ids, 1024)
    source = {r.doc_id: r.source for r in docs}
    total, window_of = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in rows:
        total[source[r.doc_id]] += r.length
        window_of[r.sequence_id][source[r.doc_id]] += r.length
    every = sum(total.values())
    for k in range(every // 1024 - 3):
        for s, n in total.items():
            assert abs(window_of[k][s] - 1024 * n / every) <= 2


def _dealt(left, window, shares=None):
    """Phases, and the turns of each queue, worked out in plain Python."""
    named = {q: x for q, x in (shares or {}).items() if x > 0}
    takes = packing.takes_of(left, named)
    takes.append({q: n for q, n in left.items() if n > 0 and q not in named})
    phases, turns, first, done = [], defaultdict(list), 0, defaultdict(int)
    for p, take in enumerate(t for t in takes if t):
        total, levels = sum(take.values()), defaultdict(list)
        for q, n in take.items():
            level = 0
            while n * window * 4**level < total:
                level += 1
            levels[level].append((n, q))
        found = [packing.Level(k, sum(n for n, _ in v), len(v), *min(v)) for k, v in levels.items()]
        phase, moved = packing.phase_of(found, first, window)
        phases.append(phase)
        first += total
        low = defaultdict(int)
        for q, n in sorted(take.items()):
            k = moved.get(q, next(k for k, v in levels.items() if (n, q) in v))
            turns[q].append((done[q], n, p, k, low[k]))
            low[k] += n
            done[q] += n
    return phases, turns


def _pieces_of(left, window, shares, rng):
    """(queue, start, place in the stream) of all pieces of documents that the queues are cut into."""
    phases, turns = _dealt(left, window, shares)
    before, n, of, flat, queues = [], [], [], [], []
    for q, total in left.items():
        at = 0
        while at < total:
            k = min(rng.choice([1, 3, 40, 700, total]), total - at)
            flat += turns[q]
            of += [len(n)] * len(turns[q])
            before.append(at)
            n.append(k)
            queues.append(q)
            at += k
    columns = dict(zip(["begin", "ids", "phase", "level", "low"], np.array(flat, np.int64).reshape(-1, 5).T))
    found = packing.pieces(phases, window, np.array(before), np.array(n), np.array(of, np.int64), columns)
    return np.array(before), np.array(n), queues, found


def _whole(before, n, found, window, total):
    """Each id lies in one piece, and all sequences but the last are full and without gaps."""
    doc, start, length, sequence, offset = found
    assert (length > 0).all() and (offset + length <= window).all()
    at = np.lexsort((start, doc))
    ends = np.r_[0, np.cumsum(length[at])]
    first = np.r_[0, np.cumsum(n)][doc[at]]
    assert (ends[:-1] - first == start[at]).all() and ends[-1] == total
    at = np.lexsort((offset, sequence))
    assert ((sequence * window + offset)[at] == np.r_[0, np.cumsum(length[at])][:-1]).all()


@pytest.mark.parametrize("seed", range(40))
def test_each_id_lies_in_one_piece(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 7, 64, 1024])
    sizes = rng.choice([[0, 1, 5, 900, 60_000], [1, 2, 3], [1, 200_000], [300, 301], [1, 10, 100, 1000, 10_000]])
    many = rng.choice([1, 2, 3, 30, 5000 if max(sizes) < 1000 else 300])
    left = {f"q{i}": rng.choice(sizes) for i in range(many)}
    if seed % 4 == 0:
        left["q0"] = 500_000  # others are due down to one id in a million
    shares = {q: rng.choice([0, 1, 2.5, 40, 1e-6]) for q in rng.sample(sorted(left), min(many, 12))} if seed % 2 else None
    before, n, _, found = _pieces_of(left, window, shares, rng)
    if sum(left.values()):
        _whole(before, n, found, window, sum(left.values()))


def test_shares_hold_for_rare_and_frequent_queues():
    """After any number of windows a queue is at most a turn away from its share."""
    window = 64
    left = {"a": 200_000, "b": 90_000, **{f"r{i}": 40 + 7 * i for i in range(200)}}
    before, n, queues, found = _pieces_of(left, window, None, random.Random(5))
    doc, _, length, sequence, _ = found
    total = sum(left.values())
    for q, size in left.items():
        mine = np.array([x == q for x in queues])[doc]
        put = np.cumsum(np.bincount(sequence[mine], length[mine], -(-total // window)))
        due = np.minimum((np.arange(len(put)) + 1) * window, total) * size / total
        assert np.abs(put - due).max() <= (2 if size > 50_000 else 5 * packing.QUANTUM)


def test_exact_shares_of_large_numbers():
    rng = random.Random(3)
    for _ in range(200):
        total = rng.randint(1, 10**13)
        places = [rng.randint(0, total) for _ in range(20)]
        upto = [rng.randint(0, total) for _ in range(20)]
        expected = [p * u // total for p, u in zip(places, upto)]
        assert packing._share(np.array(places), np.array(upto), total).tolist() == expected


def test_many_rare_sources(spark, sf_dir):
    """Forty documents have a source of their own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rare = F.when(F.col("doc_id") % 25 == 3, F.concat(F.lit("rare"), "doc_id")).otherwise(F.col("source"))
    rows = packing.pack(docs.withColumn("source", rare), PATH).withColumnRenamed("id", "doc_id").collect()
    texts = docs.collect()
    _check(rows, dict(zip([r.doc_id for r in texts], _ids([r.text for r in texts]))), 1024)


def test_more_sources_than_ids_a_window(spark):
    docs = [(i, "alpha beta " * (1 + i % 5), f"s{i % 3000}") for i in range(3500)]
    df = spark.createDataFrame(docs, SCHEMA)
    for shares in (None, {"s1": 3.0, "s2": 1e-4, None: 1.0, "none such": 2.0}):
        rows = packing.pack(df, PATH, window=64, shares=shares).withColumnRenamed("id", "doc_id").collect()
        _check(rows, dict(zip([d[0] for d in docs], _ids([d[1] for d in docs]))), 64)


def test_given_shares(spark):
    """The smaller source is asked for in half of each window until it runs out."""
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=40)), "ab"[i % 4 == 0]) for i in range(400)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("offset", F.lit(1))
    rows = packing.pack(df, PATH, window=64, shares={"a": 1.0, "b": 1.0}).withColumnRenamed("id", "doc_id").collect()
    ids = dict(zip([d[0] for d in docs], _ids([d[1] for d in docs])))
    _check(rows, ids, 64)
    got = defaultdict(lambda: [0, 0])
    for r in rows:
        got[r.sequence_id][docs[r.doc_id][2] == "b"] += r.length
    small = sum(len(ids[i]) for i in range(0, 400, 4))
    for k in range(small // 32 - 2):
        assert abs(got[k][0] - 32) <= 1


def test_edge_cases(spark):
    docs = [
        (1, None, None), (2, "", "s"), (3, "word " * 60_000, "s"), (4, " ", ""), (5, "x", None), (6, "é ü", "s"),
    ]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"queue": F.lit("q"), "row": F.lit(1)})
    rows = packing.pack(df, PATH).withColumnRenamed("id", "doc_id").collect()
    _check(rows, dict(zip([d[0] for d in docs], _ids([d[1] for d in docs]))), 1024)
    again = spark.createDataFrame([(7, "a b", "s"), (7, "a b", "s"), (None, "a b", "s")], SCHEMA)
    assert sum(r.length for r in packing.pack(again, PATH).collect()) == 9
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_have_the_ids_of_the_whole(name):
    rng = random.Random(3)
    alphabet = " \n\t\r'saét1<|>́Σ日.,_\x1c\x85\xa0 　﻿"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(5000)]
    texts += ["x<|endoftext|> y", " <|endoftext|>", "don't 's  're", "İ ẞ", "日本語 テスト  x", "\r\n\r\n x\x0b\x0cy"]
    path = public_tokenizers.path(name)
    enc = Encoder(path)
    found = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    expected = [e.ids for e in found]
    for _ in range(2):  # unknown pieces, then known ones
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(pa.array(texts))] == expected
    part = pa.array([None, *texts[:50], "q" * 5000, None]).slice(1, 51)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(part)][:50] == expected[:50]


@pytest.mark.parametrize("name, n", [("byte_bpe_50k.json", 7), ("word_bpe_49k.json", 6)])
def test_a_word_is_one_piece_whatever_stands_behind_it(name, n):
    text = "so word word, word. word; old, old. old; Word"
    enc = Encoder(public_tokenizers.path(name))
    expected = enc._plain([text.encode()])[0]
    assert np.frombuffer(enc.encode(pa.array([text]))[0], enc.dtype).tolist() == expected
    assert len(enc._keys) == n  # "so", " word", " old", the three signs, and " Word" where case counts


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cases_signs_and_marks_have_the_ids_of_the_whole(name):
    rng = random.Random(4)
    # J, H, T, W, Y and I are composed with these marks in one case only.
    parts = ["J", "j", "H", "h", "T", "t", "I", "i", "\u030c", "\u0331", "\u0308", "\u0307", "\u0338", "=", "'", "'S", "'s", "'LL", "_", ".", " ", "9", "<"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(5000)]
    texts += ["a<|startoftext|>B", "x<|", "<|endoftext", "|>", "a <|endoftext|>, b"]
    path = public_tokenizers.path(name)
    enc = Encoder(path)
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for one_by_one in (True, False):
        chunks = [pa.array([t]) for t in texts] if one_by_one else [pa.array(texts)]
        found = [x for c in chunks for x in enc.encode(c)]
        assert [np.frombuffer(x, enc.dtype).tolist() for x in found] == expected
