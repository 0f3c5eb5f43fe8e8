import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from layerloom.llm import pieces
from layerloom.llm.queries import op6_pieces
from layerloom.llm.registry import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _texts():
    rng = random.Random(1)
    alphabet = " \nabceéthinsg.,1日▁😀ßü\t"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    return texts + [
        "", " ", "  a  b ", "a\nb\n\n c", "日本語テスト ﬁ １２", "x" * 300, "▁ a▁▁b", "<s></s><unk><0x41>",
        "\t\t tab", "Ünïcödé straße", "привет мир", "0123456789 1.5e-3", "the " * 30, "\x00\x1f a",
    ]


def test_ids_and_texts_equal_the_library(library):
    texts = _texts()
    enc = pieces.PieceEncoder(PATH)
    for _ in range(2):
        ids = [np.frombuffer(x, enc.dtype) for x in enc.encode(pa.array(texts))]
        assert [x.tolist() for x in ids] == library.encode(texts)
    assert [enc.decode(x) for x in ids] == library.decode([x.tolist() for x in ids])


def test_suffix_array_ranges():
    rng = random.Random(2)
    codes = np.array([rng.choice([0, 1, 2, 3]) for _ in range(400)])
    wanted = [tuple(rng.choice([1, 2, 3]) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    table = np.zeros((60, 5), np.int64)
    for row, w in zip(table, wanted):
        row[: len(w)] = w
    suffixes, low, high = pieces._ranges(codes, table, np.array([len(w) for w in wanted]))
    assert sorted(suffixes.tolist()) == list(range(400))
    for w, a, b in zip(wanted, low, high):
        assert sorted(suffixes[a:b].tolist()) == [i for i in range(400) if tuple(codes[i : i + len(w)]) == w]


def test_suffix_array_ranges_of_many_letters():
    """A piece is longer than the letters that fit into one number."""
    rng = random.Random(3)
    words = [[rng.randint(1, 4000) for _ in range(rng.randint(1, 16))] for _ in range(40)]
    codes = []
    for _ in range(300):
        word = rng.choice(words)
        codes += [*word[: rng.randint(1, len(word))], rng.choice([0, 0, 4001])]
    wanted = {tuple(w[a:b]) for w in words for a, b in [(0, len(w)), (0, len(w) - 1), (1, len(w)), (len(w) // 2, len(w))] if a < b}
    wanted = sorted(wanted | {(5000,), (*words[0], 5000), (4001,)})
    table = np.zeros((len(wanted), 17), np.int64)
    for row, w in zip(table, wanted):
        row[: len(w)] = w
    suffixes, low, high = pieces._ranges(np.array(codes), table, np.array([len(w) for w in wanted]))
    assert sorted(suffixes.tolist()) == list(range(len(codes)))
    for w, a, b in zip(wanted, low, high):
        assert sorted(suffixes[a:b].tolist()) == [i for i in range(len(codes)) if tuple(codes[i : i + len(w)]) == w]


def test_a_word_is_one_piece_whatever_sign_stands_behind_it(library):
    signs = ["", ".", ",", "!", "###", "'s", "-x", ")."]
    texts = [f"{w}{s} {w}{s}\n{w.title()}{s}" for w in ("straße", "ting", "été", "a1b", "▁q") for s in signs]
    enc = pieces.PieceEncoder(PATH)
    ids = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(pa.array(texts))]
    assert ids == library.encode(texts)
    enc = pieces.PieceEncoder(PATH)
    enc.encode(pa.array([" ".join(f"{w}{s}" for w in ("ting", "heit") for s in ("", ".", ",", "!"))]))
    assert len(enc._keys) == 5  # two words and three signs


def test_whole_table(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents").collect()
    ids = library.encode([r.text for r in docs])
    expected = {(r.doc_id, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), True) for r, x in zip(docs, ids)}
    assert {(r.doc_id, r.n_pieces, r.ids_crc32, r.round_trip) for r in op6_pieces(spark, sf_dir).collect()} == expected


def test_edge_cases(spark, library):
    long = "word and " * 50_000
    docs = [(1, None), (2, ""), (3, long), (None, "x"), (3, "x"), (3, "x"), (4, "q" * 3000)]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"id": F.lit(1), "ids": F.lit(2)})
    encoded = pieces.encode_pieces(df, PATH)
    rows = pieces.decode_pieces(encoded, PATH).collect()
    assert len(rows) == len(docs)
    got = sorted((r.id or 0, r.n_pieces, r.text) for r in rows)
    assert got == sorted((i or 0, len(library.encode(t or "")), t or "") for i, t in docs)
    assert pieces.encode_pieces(df.limit(0), PATH).collect() == []
    nothing = spark.createDataFrame([(None,)], "ids binary")
    assert pieces.decode_pieces(nothing, PATH).first().text is None


def test_query_keeps_repeated_and_missing_ids(spark, tmp_path, library):
    docs = [(None, "no id"), (None, "nor this"), (3, "one"), (3, "another text"), (3, "one"), (4, None)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or 0, r.n_pieces, r.round_trip) for r in op6_pieces(spark, str(tmp_path)).collect())
    assert got == sorted((i or 0, len(library.encode(t or "")), True) for i, t in docs)
