"""Alignment of two tokenizers against whole texts, tokenized and linked byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerloom.llm import alignment
from layerloom.llm.queries import op12_alignment
from layerloom.llm.registry import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "digest"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {chr(b): b for b in _PLAIN}
_LETTERS |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def _bytes_a(a, i):
    return bytes(_LETTERS[c] for c in a.id_to_token(i))


def _bytes_b(b, i):
    piece = b.id_to_piece(i)
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def _linked(libraries, text):
    """(ids a, ids b, groups, links) of one text, or None."""
    a, b = libraries
    if not text:
        return None
    raw = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a, parts_b = [_bytes_a(a, i) for i in ids_a], [_bytes_b(b, i) for i in ids_b]
    if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return None
    # The token of either side that each byte lies in.
    of_a = [k for k, p in enumerate(parts_a) for _ in p]
    of_b = [k for k, p in enumerate(parts_b) for _ in p]
    links = sorted(set(zip(of_a, of_b)))
    groups, first = [], 0
    for at in range(1, len(raw) + 1):
        if at == len(raw) or (of_a[at] != of_a[at - 1] and of_b[at] != of_b[at - 1]):
            groups.append([sorted(set(x[first:at])) for x in (of_a, of_b)])
            first = at
    joined = ";".join("|".join(",".join(str(ids[k]) for k in ks) for ids, ks in zip((ids_a, ids_b), g)) for g in groups)
    return ids_a, ids_b, groups, [(ids_a[i], ids_b[j]) for i, j in links], joined


def _brute(libraries, docs):
    cache = {t: _linked(libraries, t) for t in {t for _, t in docs}}
    counts = Counter(p for _, t in docs if cache[t] for p in cache[t][3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for i, t in docs:
        if cache[t] is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups, links, joined = cache[t]
        best = sum(counts[p] == most[p[1]] for p in links)
        total = sum(counts[p] for p in links)
        digest = hashlib.sha256(joined.encode()).hexdigest()
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), best, total, digest))
    return out, counts


def _order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r))


def test_whole_table(spark, sf_dir, libraries):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    found = [tuple(r[c] for c in ("doc_id", *NAMES[:-1], "groups_sha256")) for r in op12_alignment(spark, sf_dir).collect()]
    assert sorted(found) == sorted(_brute(libraries, docs)[0])


AWKWARD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b", "a \n b", "x   y", "x  y", "a　 b", "<0x0A> <s> </s> <unk>",
    "<|endoftext|> x <|endoftext|>", "▁", "a▁b", "\x00", "a\x00 b", "日本語 テスト", "é é ﬁ", "\r\n \r\n", "{\r\n }\r", "don't 's",
    "   \t  \t ", "a  b", "🙂🙂 x", "﻿ x", "1 234  567", "word " * 3000, "q" * 20_000, "\x85 \x85", "a\x1c b", "​ z",
]


def test_awkward_texts(spark, libraries, monkeypatch):
    rng = random.Random(4)
    alphabet = " \n\t\r'saét1<|>́Σ日.,_\x1c\x85\xa0 　﻿▁"
    texts = AWKWARD + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(1500)]
    texts += rng.choices(texts, k=300) + ["again and again"] * 400
    docs = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"key": F.lit(1), "copies": F.lit("x")})
    made = alignment.Alignment(df, A, B)
    rows, counts = _brute(libraries, docs)
    assert _order(tuple(r[c] for c in ("id", *NAMES)) for r in made.measures().collect()) == _order(rows)
    assert {(r.a, r.b): r.n for r in made.pairs().collect()} == counts


def test_blocks_and_forgetting(libraries, monkeypatch):
    """Many small blocks give the same weights as one, also when units are learnt anew."""
    monkeypatch.setattr(alignment, "KNOWN_CHARS", 50)
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "x\n", "", "étude"], k=rng.randint(1, 30))) for _ in range(200)]
    texts = [t or "a" for t in texts]
    copies = [rng.randint(1, 5) for _ in texts]
    known, total = alignment.Aligner(A, B), Counter()
    for i in range(0, 200, 7):
        pairs, weights, *_ = alignment._aligned(known, [b"k" * 32] * 7, texts[i : i + 7], copies[i : i + 7])
        total.update(dict(zip(pairs, weights)))
    _, counts = _brute(libraries, [(0, t) for t, n in zip(texts, copies) for _ in range(n)])
    assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in total.items()} == counts


def test_empty_table(spark):
    made = alignment.Alignment(spark.createDataFrame([], "doc_id bigint, text string"), A, B)
    assert made.measures().collect() == [] and made.pairs().collect() == []
    only = alignment.Alignment(spark.createDataFrame([(1, None), (2, "▁")], "doc_id bigint, text string"), A, B)
    assert sorted(tuple(r) for r in only.measures().collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
