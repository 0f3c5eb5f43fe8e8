import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerloom.llm import rans, tokens
from layerloom.llm.queries import op10_rans
from layerloom.llm.registry import table

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string"


def _ids(texts, end=1):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, end], "<u4") for e in found]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 31, 32, 33, 1000, 5001])
@pytest.mark.parametrize("kind", ["flat", "steep", "one"])
def test_blocks_round_trip_from_every_checkpoint(n, kind):
    rng = np.random.default_rng(n)
    ids = {"flat": rng.integers(0, 60_000, n), "steep": rng.geometric(0.3, n), "one": np.full(n, 9)}[kind].astype(np.uint32)
    counts = np.bincount(ids, minlength=70_000) if n else np.zeros(5, np.int64)
    table = rans.Frequencies.of(rans.scaled(counts))
    payload = rans.encode_block([n], ids, table, lanes=4, every=8)
    block = rans.Block.parse(payload, table)
    symbols = table.symbols()
    assert np.array_equal(block.decode(table, symbols), ids)
    for p in reversed(range(len(block.offsets))):
        assert np.array_equal(block.decode_from(p, table, symbols), ids[p * 32 : p * 32 + 32])


def test_scaled_frequencies():
    rng = random.Random(1)
    for _ in range(50):
        counts = np.array([rng.choice([0, 0, 1, 1, 2, 10**rng.randint(0, 15)]) for _ in range(rng.randint(1, 3000))])
        out = rans.scaled(counts)
        total = int(out.sum())
        assert total & (total - 1) == 0
        if counts.any():
            assert ((out > 0) == (counts > 0)).all()
    many = rans.scaled(np.ones(300_000, np.int64))
    assert many.min() >= 1 and int(many.sum()) & (int(many.sum()) - 1) == 0


def test_size_is_close_to_the_entropy():
    ids = np.random.default_rng(5).geometric(0.02, 300_000).astype(np.uint32)
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum() * len(ids) / 8
    payload = rans.encode_block([len(ids)], ids, rans.Frequencies.of(rans.scaled(counts)), lanes=64, every=1 << 20)
    assert len(payload) < 1.02 * entropy + 2000


def test_damage_is_noticed():
    ids = np.arange(500, dtype=np.uint32)
    table = rans.Frequencies.of(rans.scaled(np.bincount(ids)))
    payload = bytearray(rans.encode_block([500], ids, table))
    payload[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.Block.parse(bytes(payload), table)
    with pytest.raises(ValueError, match="short"):
        rans.Block.parse(b"x", table)
    with pytest.raises(ValueError, match="not in the frequency table"):
        rans.encode_block([1], np.array([501], np.uint32), table)


class _Watched:
    """A tokenizer that keeps the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_unknown_words_are_tokenized_many_at_a_time():
    words = [f"{a}{b}{c}" for a in ("ting", "été", "STRASSE", "ñandú") for b in ("heit", "ø", "one") for c in "abcdefghijklmn"]
    text = " ".join(words) + " sign, 1st"
    enc = tokens.Encoder(PATH)
    enc._tokenizer = _Watched(enc._tokenizer)
    assert [[*np.frombuffer(x, enc.dtype), 1] for x in enc.encode(pa.array([text]))] == [x.tolist() for x in _ids([text])]
    [parted] = [t for t in enc._tokenizer.texts if "<|" in t]
    assert sorted(parted.split("<|startoftext|>")) == [" 1st", ","]  # the others are words
    assert len(enc._tokenizer.texts) == 1 + -(-(len(words) + 1) // tokens._TOGETHER)


def test_ids_of_odd_words_equal_the_library():
    rng = random.Random(4)
    odd = ["İstanbul", "ŉ", "ǅ", "ß", "e\u0301", "x\u0301y", "straße", "ÉTÉ", "a1b", "don't", "we'll", "'s", "été.", "日本", "привет",
           "ﬁ", "K", "×", "a×b", "\u0307", "\u200b", "\xa0", "<|endoftext|>", "_a_", "²", "ª", "ab²", "x" * 80, "\x00", "\x1c"]
    spaces = [" ", "\t", "\n", "\r\n", "\v", "\f", "  ", "\x85", "\u2028", ""]
    texts = ["".join(rng.choice(odd) + rng.choice(spaces) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    for part in (texts, [t for t in texts if t.isascii()], odd, ["İ", "İa"], ["a", "a\u0301"]):
        enc = tokens.Encoder(PATH)
        for _ in range(2):
            found = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(pa.array(part))]
            assert found == [x[:-1].tolist() for x in _ids(part)]


def test_distinct_hashes():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 70_000):
        close = rng.integers(0, 50, n).astype(np.uint64) + np.uint64(1 << 60)  # differ in the lowest bits only
        for hashes in (rng.integers(0, 1 << 64, n, np.uint64), rng.integers(0, 1 << 64, 60, np.uint64)[rng.integers(0, 60, n)], close):
            expected = np.unique(hashes, return_index=True, return_inverse=True)
            assert all(np.array_equal(a, b) for a, b in zip(tokens._distinct(hashes), expected))


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    expected, at = set(), 0
    for r, ids in zip(docs, _ids([r.text for r in docs])):
        expected.add((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op10_rans(spark, sf_dir).collect()} == expected


def test_edge_cases(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_IDS", 100)
    docs = [(3, None), (1, ""), (2, "Many words here " * 40_000), (None, "last"), (3, "b"), (3, "b"), (-5, " \n")]
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"id": F.lit(1), "row": F.lit(2), "part": F.lit(3)})
    rans.write_ids(df, f"{tmp_path}/x", PATH)
    rows = sorted(rans.read_ids(spark, f"{tmp_path}/x").collect(), key=lambda r: r.start)
    assert [r.id for r in rows] == [-5, 1, 2, 3, 3, 3, None]
    texts = [" \n", "", "Many words here " * 40_000, None, "b", "b", "last"]
    at = 0
    for r, ids in zip(rows, _ids(texts)):
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(ids), ids.tobytes())
        at += len(ids)
    rans.write_ids(df.limit(0), f"{tmp_path}/y", PATH)
    assert rans.read_ids(spark, f"{tmp_path}/y").collect() == []
