"""The operators of this subpackage on the given tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm.alignment import Alignment
from layerloom.llm.forest import nearest
from layerloom.llm.katz import katz_scores
from layerloom.llm.langid import learnt_from, predict
from layerloom.llm.packing import pack
from layerloom.llm.parity import overlapping
from layerloom.llm.pieces import decode_pieces, encode_pieces
from layerloom.llm.preference import preference_pairs, with_other_tail
from layerloom.llm.quality import judged
from layerloom.llm.rans import read_ids, write_ids
from layerloom.llm.registry import query, table
from layerloom.llm.repair import Repair, damaged
from layerloom.llm.simhash import near_duplicates
from layerloom.llm.sql import PREFERENCE_SQL, QUALITY_SQL
from layerloom.llm.substring import remove_repeats
from layerloom.storage import shared_folder, staged


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op9_substring")
def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = remove_repeats(docs, length=20, with_text=False)
    return cleaned.select("doc.doc_id", "n_words", "n_removed", "kept_sha256")


@query("op5_quality", QUALITY_SQL)
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judged(docs).select(
        "doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.filter(learnt_from("doc_id"))
    out = predict(docs.select("doc_id", "text"), learn)
    return out.select("doc.doc_id", (~learnt_from("doc.doc_id")).alias("held_out"), "lang_pred", "score")


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0, window=1024)
    return out.withColumnRenamed("id", "doc_id")


@query("op10_rans")
def op10_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = f"{shared_folder(spark)}/rans-{uuid.uuid4().hex}"
    write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    out = read_ids(spark, path)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op3_forest")
def op3_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op2_katz")
def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(10)) == 0
    return katz_scores(docs, held_out).withColumnRenamed("id", "doc_id")


@query("op4_preference", PREFERENCE_SQL)
def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is preferred to one that goes on, from some turn, like the next one."""
    turns = table(spark, sf_dir, "conversations")
    pairs = preference_pairs(turns, with_other_tail(turns))

    def spans(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda s: F.concat(s["start"], F.lit("-"), s["end"])), ",").alias(mask)

    return pairs.select(
        F.col("pair").alias("conv_id"),
        "prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        spans("chosen_mask"),
        spans("rejected_mask"),
    )


@query("op6_pieces")
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as pieces, and whether the pieces give the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    given = F.xxhash64(F.coalesce("text", F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", given.alias("given"))
    # The hash goes with its row: ids may be repeated or missing.
    encoded = staged(encode_pieces(docs, model, carried=["given"]), "pieces", compression="zstd")
    return decode_pieces(encoded, model).select(
        F.col("id").alias("doc_id"), "n_pieces", "ids_crc32", (F.xxhash64("text") == F.col("given")).alias("round_trip")
    )


@query("op11_repair")
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by a checksum of its turns, and its cheapest repair."""
    turns = table(spark, sf_dir, "conversations")
    found = Repair(damaged(turns)).summary()
    every = turns.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = Alignment(docs, *paths).measures()
    return found.withColumnsRenamed({"id": "doc_id", "digest": "groups_sha256"})


@query("op13_parity")
def op13_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = overlapping(docs, shingle=4, percent=85)
    return found.withColumnsRenamed({"id": "doc_id", "n": "n_shingles", "component": "component_id"})
