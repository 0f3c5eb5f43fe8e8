"""From source systems to the landing and bronze layers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.functions import columns as cols
from layerloom.metadata import API, DATABASE, FILES, TableConfig
from layerloom.operators.incremental import load_slice
from layerloom.plans.lake import BRONZE, LANDING, SILVER, AuditRow, Lake
from layerloom.sources import files, jdbc, rates


@dataclass(frozen=True)
class Sources:
    """Where the source systems are; connection settings are given at run time."""

    folder: str
    jdbc_options: Mapping[str, str] = field(default_factory=dict)
    jdbc_splits: Mapping[str, jdbc.Split | None] = field(default_factory=dict)


# Folder column of landed rows: sound ones, and records that could not be read.
RECORDS, SOUND, BROKEN = "_Records", "sound", "broken"
_CHECKS = [files.SOURCE_FILE, files.BAD_RECORD, files.BAD_REASON]


def read_source(lake: Lake, config: TableConfig, sources: Sources) -> DataFrame:
    """Rows of a source; those of files and answers come with what could not be read (``read_checked``)."""
    if config.source_type == FILES:
        path = f"{sources.folder}/{config.source_name}"
        if config.file_format in (files.CSV, files.JSON):
            return files.read_checked(lake.spark, path, config.file_format)
        return files.read_files(lake.spark, path, config.file_format)
    if config.source_type == DATABASE:
        if config.table_name not in sources.jdbc_splits:
            raise ValueError(
                f"database table {config.table_name!r} needs a split, or jdbc.ONE_CONNECTION if it is small"
            )
        split = sources.jdbc_splits[config.table_name]
        return jdbc.read_table(lake.spark, config.source_name, sources.jdbc_options, split)
    if config.source_type == API:
        path = f"{sources.folder}/{config.source_name}"
        return rates.checked_answers(lake.spark, path)
    raise ValueError(f"unknown source type {config.source_type!r}")


def land(lake: Lake, config: TableConfig, sources: Sources, run: RunContext) -> AuditRow:
    """Copy the rows to load into the landing layer.

    Incremental tables take the rows past the mark that the silver layer has
    committed: a run that fails on the way is repeated from the same mark. Rows
    without a readable watermark are taken every time, so that they end up
    among the rejected rows instead of vanishing. Records that could not be
    read are landed beside the rows and counted as rejected.
    """
    source = read_source(lake, config, sources)
    for name in _CHECKS:
        if name not in source.columns:
            source = source.withColumn(name, F.lit(None).cast("string"))
    broken = F.col(files.BAD_RECORD).isNotNull()
    if config.watermark_column and config.watermark_column in source.columns:
        mark = lake.last_mark(SILVER, config.table_name)
        by = F.col(config.watermark_column).try_cast("timestamp")
        literal = None if mark is None else F.lit(mark.isoformat(sep=" ")).cast("timestamp")
        marked = source.withColumn("__mark", by)
        source = load_slice(
            marked, config.load_type, "__mark", literal, inclusive=True, undated=True
        ).drop("__mark")
    return lake.write(
        cols.stamp_landed(source, run).withColumn(RECORDS, F.when(broken, BROKEN).otherwise(SOUND)),
        LANDING,
        config.table_name,
        run,
        table_format=config.file_format,
        partition_by=[RECORDS],
        rejected=broken,
    )


def landed_rows(lake: Lake, name: str) -> DataFrame:
    """The sound rows of the last landing."""
    return lake.read(LANDING, name).where(F.col(RECORDS) == SOUND).drop(RECORDS, *_CHECKS)


def bad_records(lake: Lake, name: str) -> DataFrame | None:
    """(file, reason, record, batch) of what no run could read."""
    landed = lake.read_batches(LANDING, name)
    if landed is None:
        return None
    return landed.where(F.col(RECORDS) == BROKEN).select(
        F.col(files.SOURCE_FILE).alias("file"),
        F.col(files.BAD_REASON).alias("reason"),
        F.col(files.BAD_RECORD).alias("record"),
        F.col("BatchID").alias("batch"),
    )


def to_bronze(
    raw: DataFrame, run: RunContext, *, business: list[str] | None = None
) -> DataFrame:
    """Raw rows as strings with clean names, ingest stamps and a record hash.

    The hash covers the business columns only, so it stays the same when an
    unchanged row is loaded again.
    """
    clean = cols.sanitize_columns(cols.as_strings(raw))
    stamped = cols.stamp_ingested(clean, run)
    hashed = business or cols.business_columns(clean, run)
    return stamped.withColumn(run.columns.record_hash, cols.record_hash(stamped, hashed))


def load_bronze(lake: Lake, config: TableConfig, run: RunContext) -> AuditRow:
    return lake.write(
        to_bronze(landed_rows(lake, config.table_name), run),
        BRONZE,
        config.table_name,
        run,
        table_format=config.target_file_format,
    )
