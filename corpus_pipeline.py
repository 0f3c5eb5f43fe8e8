"""From raw documents to packed training sequences.

Stages: language identification drops what has no recognisable language, quality
rules drop what is unlike sound documents of its language and source, SimHash
keeps one document of each group of near copies, substring removal cuts passages
that stood earlier, and packing turns the rest into training sequences.

Every stage is written down and read again by the next one.

All stages take NULLs in any column, empty and very long texts, repeated rows and
ids, empty tables and further columns of any name; the columns come out as they
were. Rows that share an id come in the order of their texts, rows without one
come last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm.langid import UNDECIDED, learnt_from, predict
from layerloom.llm.packing import pack
from layerloom.llm.quality import judged
from layerloom.llm.registry import import_on_workers
from layerloom.llm.simhash import without_near_duplicates
from layerloom.llm.substring import remove_repeats
from layerloom.storage import staged

#: Documents whose likeliest language has a smaller mean probability are rejected.
MIN_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a recognised language, and name it.

    NULL and empty texts, and those without a letter, are not recognised. A NULL
    ``lang`` is not learnt from, but is filled in.
    """
    found = predict(docs, docs.filter(learnt_from("doc_id")), with_text=True)
    kept = found.filter((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(
        *[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the rules of their language and source.

    NULL and empty texts have too few words to pass. NULL languages and sources
    are groups of their own. Repeated rows are judged one by one.
    """
    return judged(docs, with_docs=True).filter("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near copies.

    Texts without a word are copies of each other. Of repeated rows one stays; a
    group without any id keeps one row.
    """
    return without_near_duplicates(docs, shingle=3, distance=3)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 20 words or more that stood earlier; other text stays as it is.

    A NULL text stays NULL, an empty one empty. ``n_chars`` is counted anew. A
    repeated row loses what it shares with the first.
    """
    cut = remove_repeats(docs, length=20).withColumn("n_chars", F.length("text").cast("long"))
    own = {"text", "n_chars"}
    return cut.select(
        *[F.col(c) if c in own else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids.

    NULL and empty texts are one id, the end. NULL sources are a queue of their
    own. Repeated rows are packed each; an empty table gives no pieces.
    """
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0, window=1024)
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("packing", packing),
]

#: The network, fingerprints and tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    import_on_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
