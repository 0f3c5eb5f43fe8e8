"""Quality rules whose thresholds follow the documents of a language and source.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.rows import wrapped
from layerloom.storage import staged

_SPACES = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = "[#*$%&|<>]"
WINDOW_WORDS = 8

#: Fewest words, and largest share of repeated words in percent, whatever the corpus.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Measures as whole numbers, so that sketches and thresholds are exact: name -> (numerator, factor, denominator).
MEASURES = {
    "symbols": ("n_symbols", 1000, "n_words"),
    "dup_lines": ("n_dup_lines", 1000, "n_lines"),
    "repeats": ("n_repeat_words", 1000, "n_words"),
    "word_length": ("word_chars", 100, "n_words"),
}
#: Distance from the quartiles that is always allowed, in the units of the measure.
SLACK = {"symbols": 50, "dup_lines": 100, "repeats": 50, "word_length": 50}
#: What a text may have beyond its fence whatever its length, counted as the numerator is:
#: in short texts a few symbols, lines or letters make a large share.
FREE = {"symbols": 3, "dup_lines": 2, "repeats": 32, "word_length": 25}
#: Measures that may be too small as well.
TWO_SIDED = ("word_length",)
#: Quartile distances allowed beyond a quartile.
SPREAD = 3
#: A sketch of fewer documents gives way to that of the language, then of the corpus.
MIN_DOCS = 200
#: Leading bits that a sketch keeps of a value: relative error below 2**-5.
SKETCH_BITS = 6


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def _doubled(hashes: str, step: int) -> Column:
    """Hashes of runs twice as long, from those that start now and ``step`` words later."""
    later = F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(hashes, later, lambda a, b: F.xxhash64(a, b))


def with_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Repeated windows are told by their 64-bit hashes within one text. Each
    step is a column of its own, so that no array is computed twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD))
    counted = (
        docs.withColumn("_words", _words(text))
        .withColumn("_lines", lines)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.regexp_replace(text, _SYMBOL, ""))).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    )
    windows = F.slice("_hashes8", F.lit(1), F.greatest(F.size("_words") - (WINDOW_WORDS - 1), F.lit(0)))
    # Only texts that repeat a window are sorted.
    placed = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    repeated = F.sort_array(
        F.transform(
            F.filter(
                "_placed",
                lambda p, k: F.coalesce(F.get("_placed", k + 1)["h"] == p["h"], F.lit(False))
                | F.coalesce(F.get("_placed", k - 1)["h"] == p["h"], F.lit(False)),
            ),
            lambda p: p["i"],
        )
    )
    covered = F.aggregate(
        F.transform(
            "_repeated",
            lambda p, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("_repeated", k + 1) - p, F.lit(WINDOW_WORDS))),
        ),
        F.lit(0).cast("long"),
        lambda a, n: a + n,
    )
    return (
        counted.withColumn("_hashes2", _doubled("_words", 1))
        .withColumn("_hashes4", _doubled("_hashes2", 2))
        .withColumn("_hashes8", _doubled("_hashes4", 4))
        .withColumn("_windows", windows)
        .withColumn("_placed", placed)
        .withColumn("_repeated", repeated)
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
        .drop("_words", "_lines", "_hashes2", "_hashes4", "_hashes8", "_windows", "_placed", "_repeated")
    )


def _bucket(value: Column) -> Column:
    """Smallest value that the sketch does not tell apart from this one."""
    dropped = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, dropped), dropped)


def sketches(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, n): log-linear quantile sketches, mergeable by adding up n."""
    measures = F.array(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                # A text of words has lines, so the denominators are not 0.
                F.call_function("div", F.col(top) * factor, F.greatest(F.col(below), F.lit(1))).alias("value"),
            )
            for m, (top, factor, below) in MEASURES.items()
        ]
    )
    values = counts.select(*keys, F.explode(measures).alias("m")).select(*keys, "m.*")
    return values.groupBy(*keys, "measure", _bucket(F.col("value")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row per key: number of documents, and the lowest and highest value of each measure.

    A fence lies ``SPREAD`` quartile distances beyond a quartile, plus the slack.
    """
    of = Window.partitionBy(*keys, "measure")
    upto = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("docs", F.sum("n").over(of))

    def quantile(quarter: int) -> Column:
        reached = F.col("upto") * 4 >= F.col("docs") * quarter
        return F.min(F.when(reached, F.col("bucket")))

    bounds = ranked.groupBy(*keys, "measure").agg(
        F.first("docs").alias("docs"), quantile(1).alias("q1"), quantile(3).alias("q3")
    )
    width = (F.col("q3") - F.col("q1")) * SPREAD
    slack = F.create_map(*[F.lit(x) for item in SLACK.items() for x in item])[F.col("measure")]
    columns = [F.max("docs").alias(f"{prefix}_docs")]
    for m in MEASURES:
        of_m = F.col("measure") == m
        columns.append(F.max(F.when(of_m, F.col("q3") + width + slack)).alias(f"{prefix}_{m}_high"))
        if m in TWO_SIDED:
            columns.append(F.max(F.when(of_m, F.col("q1") - width - slack)).alias(f"{prefix}_{m}_low"))
    return bounds.groupBy(*keys).agg(*columns)


def thresholds(counts: DataFrame) -> DataFrame:
    """(t_lang, t_source, <measure>_high, <measure>_low) from (lang, source, counts) of the sound documents.

    One pass makes the sketches of all languages and sources; those of
    languages and of the corpus are merged from them.
    """
    fine = staged(sketches(counts, ["lang", "source"]), "sketches")
    by_pair = fences(fine, ["lang", "source"], "pair")
    by_lang = fences(merged(fine, ["lang"]), ["lang"], "lang").withColumnRenamed("lang", "l_lang")
    # The fences of the corpus are one row.
    corpus = fences(merged(fine.withColumn("one", F.lit(1)), ["one"]), ["one"], "all").first()
    joined = by_pair.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")))

    def chosen(bound: str) -> Column:
        return (
            F.when(F.col("pair_docs") >= MIN_DOCS, F.col(f"pair_{bound}"))
            .when(F.col("lang_docs") >= MIN_DOCS, F.col(f"lang_{bound}"))
            .otherwise(F.lit(corpus[f"all_{bound}"] if corpus else None).cast("long"))
            .alias(bound)
        )

    bounds = [f"{m}_high" for m in MEASURES] + [f"{m}_low" for m in TWO_SIDED]
    return joined.select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *[chosen(b) for b in bounds]
    )


def _within(measure: str) -> Column:
    """Whether a measure keeps its fences, without dividing."""
    top, factor, below = MEASURES[measure]
    value, base = F.col(top) * factor, F.greatest(F.col(below), F.lit(1))
    free = FREE[measure] * factor
    holds = value <= F.col(f"{measure}_high") * base + free
    if measure in TWO_SIDED:
        holds = holds & (value >= F.col(f"{measure}_low") * base - free)
    return holds


def judged(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    *,
    with_docs: bool = False,
) -> DataFrame:
    """doc (a struct of the columns), the counts, base_failed and kept, one row per document.

    ``doc`` leaves the text out unless ``with_docs`` is set. The counts are
    written once, the sketches of the documents that pass the base rules give
    thresholds per language and source, and these are joined back.

    - NULL and empty texts have no words and fail the base rules.
    - NULL languages and sources are groups like any other.
    - Repeated rows and ids are judged one by one; an empty table gives an empty result.
    """
    columns = [c for c in docs.columns if with_docs or c != text_col]
    rows = wrapped(docs, text_col, text_col).select(
        F.struct(*[F.col(f"doc.`{c}`").alias(c) for c in columns]).alias("doc"),
        "text",
        F.col(f"doc.`{lang_col}`").alias("lang"),
        F.col(f"doc.`{source_col}`").alias("source"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    counts = staged(with_counts(rows, "text").drop("text").withColumn("base_failed", failed), "quality")
    bounds = thresholds(counts.filter("not base_failed").drop("doc"))
    pair = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    verdict = reduce(Column.__and__, [_within(m) for m in MEASURES])
    kept = ~F.col("base_failed") & F.coalesce(verdict, F.lit(False))
    return counts.join(bounds, pair, "left").select(
        "doc",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
    )
