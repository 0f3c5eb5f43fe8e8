"""Exchange rates from landed API answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.sources.files import BAD_REASON, BAD_RECORD, SOURCE_FILE, sound

# Shape of an API answer and of the rows made of it.
ANSWER_SCHEMA = "base_code string, conversion_rates map<string,double>, time_last_update_unix bigint"
RATE_COLUMNS = ["BaseCurrency", "TargetCurrency", "ExchangeRate", "RateDate"]


def json_map(text: Column) -> Column:
    """A JSON object of numbers as a map."""
    return F.from_json(text, "map<string,double>")


def rate_rows(answers: DataFrame, rate_date: Column) -> DataFrame:
    """One row per target currency of each answer."""
    return answers.select(
        F.col("base_code").alias("BaseCurrency"),
        F.explode("conversion_rates").alias("TargetCurrency", "ExchangeRate"),
        rate_date.alias("RateDate"),
    )


def read_answers(spark: SparkSession, path: str, rate_date: Column | None = None) -> DataFrame:
    """The rates of ``checked_answers``, without what could not be read."""
    return sound(checked_answers(spark, path, rate_date))


def checked_answers(spark: SparkSession, path: str, rate_date: Column | None = None) -> DataFrame:
    """Answers saved as JSON files, one object per file.

    Rates are of the given date, else of the day that the answer names as its
    last update (UTC), else of the day on which the file was saved. A file that
    is cut off, or holds no rates, is a broken record, as in ``read_checked``.
    """
    reader = spark.read.schema(f"{ANSWER_SCHEMA}, {BAD_RECORD} string").option("multiLine", True)
    answers = reader.option("columnNameOfCorruptRecord", BAD_RECORD).json(path)
    if rate_date is None:
        updated = F.timestamp_seconds("time_last_update_unix")
        rate_date = F.to_date(F.coalesce(updated, F.col("_metadata.file_modification_time")))
    whole = F.col("base_code").isNotNull() & F.col("conversion_rates").isNotNull() & F.col(BAD_RECORD).isNull()
    # One row per target currency of each answer; a broken one stays a row.
    return answers.select(
        F.when(whole, F.col("base_code")).alias("BaseCurrency"),
        F.explode_outer(F.when(whole, F.col("conversion_rates"))).alias("TargetCurrency", "ExchangeRate"),
        F.when(whole, rate_date).alias("RateDate"),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.when(~whole, F.coalesce(BAD_RECORD, F.to_json(F.struct("base_code", "conversion_rates")))).alias(BAD_RECORD),
        F.when(~whole, F.lit("not an answer with rates")).alias(BAD_REASON),
    )
