"""File sources and sinks of the landing layer."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV, JSON = "csv", "json"

#: Columns that ``read_checked`` adds: the file, and what a broken record looks like and why it is one.
SOURCE_FILE, BAD_RECORD, BAD_REASON = "_SourceFile", "_BadRecord", "_BadReason"


def _strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; every column is a string.

    Columns are taken by position, so all files must have the same header: a
    file with another one is an error when it is read, not a silent mix-up.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    return reader.option("enforceSchema", False).csv(path)


def read_json(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON lines; every column is a string holding the literal as written.

    With ``columns`` the files are read once and in that column order. Without,
    an extra pass finds the names, which then come in alphabetical order.
    """
    if columns:
        return spark.read.schema(_strings(columns)).json(path)
    return spark.read.option("primitivesAsString", True).json(path)


def read_raw(
    spark: SparkSession, path: str, file_format: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read a landed file with all columns as strings."""
    if file_format == CSV:
        return read_csv(spark, path)
    if file_format == JSON:
        return read_json(spark, path, columns)
    raise ValueError(f"unsupported file format {file_format!r}")


def read_files(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """Read a source folder in its configured format."""
    if file_format in (CSV, JSON):
        return read_raw(spark, path, file_format)
    return spark.read.format(file_format).load(path)


@dataclass(frozen=True)
class CsvFiles:
    """CSV files with one header, and whether quoted values of theirs may hold line breaks."""

    columns: tuple[str, ...]
    breaks: bool
    paths: tuple[str, ...]


def _literal(path: str) -> str:
    """A path as Spark lists it, as one that it reads: no escapes, no patterns."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", unquote(path))


def literal_paths(paths: Sequence[str]) -> list[str]:
    """Paths as Spark lists files, as ones that it reads."""
    return [_literal(p) for p in paths]


def csv_files(spark: SparkSession, paths: str | Sequence[str]) -> list[CsvFiles]:
    """The files of a source by header, found in one pass over their lines.

    A line with an odd number of quotes belongs to a value with a line break;
    only files with such lines are read as a whole by one task each. One row
    per file reaches the driver, as the list of files does in any read.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    starts = F.col("start") == 0
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    found = lines.groupBy("file").agg(
        F.min_by(F.when(starts, F.col("value")), F.when(starts, F.col("at"))).alias("header"),
        F.max(quotes % 2 == 1).alias("breaks"),
    )
    groups: dict[tuple, list[str]] = {}
    for row in sorted(found.collect(), key=lambda r: r.file):
        columns = tuple(next(csv.reader([(row.header or "").removeprefix("\ufeff")]), ()))
        repeated = sorted({c for c in columns if [x.lower() for x in columns].count(c.lower()) > 1})
        if repeated or not columns:
            raise ValueError(f"{row.file}: the header has no columns, or names {repeated} twice")
        groups.setdefault((columns, row.breaks), []).append(row.file)
    return [CsvFiles(columns, breaks, tuple(files)) for (columns, breaks), files in groups.items()]


def _checked(frame: DataFrame, columns: Sequence[str], reason: Column) -> DataFrame:
    bad = F.col(BAD_RECORD)
    if columns:
        # Always true: Spark refuses to read broken records without another column.
        bad = F.when(F.xxhash64(f"`{columns[0]}`") >= -(1 << 63), bad)
    # A broken record has no values: what could be read of it may be shifted.
    values = [F.when(bad.isNull(), F.col(f"`{c}`")).alias(c) for c in columns]
    file = F.col("_metadata.file_path").alias(SOURCE_FILE)
    return frame.select(*values, file, bad.alias(BAD_RECORD), F.when(bad.isNotNull(), reason).alias(BAD_REASON))


def _read_csv_files(spark: SparkSession, files: CsvFiles) -> DataFrame:
    reader = spark.read.schema(_strings([*files.columns, BAD_RECORD]))
    reader = reader.option("header", True).option("multiLine", files.breaks)
    # Without pruning all fields are counted, whatever columns are asked for.
    reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", False)
    frame = reader.csv(literal_paths(files.paths))
    return _checked(frame, files.columns, F.lit(f"not {len(files.columns)} fields"))


def read_checked(
    spark: SparkSession, paths: str | Sequence[str], file_format: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV or JSON records with ``_SourceFile``, ``_BadRecord`` and ``_BadReason``.

    Every record comes back: a sound one with its values as strings, one with
    missing or further fields or of broken JSON as its text and the reason. CSV
    columns are matched by the names in each file's header, so files may differ
    in the order of columns, or lack some. No files, or empty ones, give no rows.
    """
    if file_format == CSV:
        frames = [_read_csv_files(spark, f) for f in csv_files(spark, paths)]
        if not frames:
            names = list(columns or [])
            return spark.createDataFrame([], _strings([*names, SOURCE_FILE, BAD_RECORD, BAD_REASON]))
        found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        names = [c for c in found.columns if c not in (SOURCE_FILE, BAD_RECORD, BAD_REASON)]
        names = [*(columns or []), *[c for c in names if c not in (columns or [])]]
        missing = [F.lit(None).cast("string").alias(c) for c in names if c not in found.columns]
        held = [F.col(f"`{c}`") for c in found.columns]
        return found.select(*held, *missing).select(*[f"`{c}`" for c in names], SOURCE_FILE, BAD_RECORD, BAD_REASON)
    if file_format == JSON:
        if columns is None:
            schema = read_json(spark, paths).schema
            schema = T.StructType([f for f in schema if f.name != "_corrupt_record"])
        else:
            schema = _strings(columns)
        reader = spark.read.schema(T.StructType([*schema, T.StructField(BAD_RECORD, T.StringType())]))
        frame = reader.option("columnNameOfCorruptRecord", BAD_RECORD).json(paths)
        return _checked(frame, schema.names, F.lit("not a JSON object"))
    raise ValueError(f"unsupported file format {file_format!r}")


def sound(checked: DataFrame) -> DataFrame:
    """The sound records alone."""
    return checked.where(F.col(BAD_RECORD).isNull()).drop(SOURCE_FILE, BAD_RECORD, BAD_REASON)


def bad(checked: DataFrame) -> DataFrame:
    """(file, reason, record) of the broken ones."""
    broken = checked.where(F.col(BAD_RECORD).isNotNull())
    return broken.select(*[F.col(c).alias(n) for c, n in ((SOURCE_FILE, "file"), (BAD_REASON, "reason"), (BAD_RECORD, "record"))])


# Landed text: all values quoted, quotes doubled, nothing trimmed, one record a line.
LANDED = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_NULL, _EMPTY = "\\N", "\\E"
_ESCAPES = [("\n", "\\n"), ("\r", "\\r")]


def _replaced(value: Column, old: str, new: str) -> Column:
    return F.replace(value, F.lit(old), F.lit(new))


def escaped(value: Column) -> Column:
    """A text that CSV gives back unchanged: a marker for NULL and for '', line breaks and backslashes escaped."""
    text = _replaced(value.cast("string"), "\\", "\\\\")
    for plain, mark in _ESCAPES:
        text = _replaced(text, plain, mark)
    return F.when(value.isNull(), _NULL).when(text == "", _EMPTY).otherwise(text)


def unescaped(text: Column) -> Column:
    """The value that ``escaped`` made a text of."""

    def part(piece: Column) -> Column:
        for plain, mark in _ESCAPES:
            piece = _replaced(piece, mark, plain)
        return piece

    # Between doubled backslashes a single one can only begin an escape.
    whole = F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")
    value = F.when(F.instr(text, "\\") == 0, text).otherwise(whole)
    return F.when(text == _EMPTY, "").when(text != _NULL, value)


def write_csv(
    df: DataFrame, path: str, *, header: bool = True, single_file: bool = False
) -> None:
    """Replace a folder of CSV files. One file means one writing task, so it is
    for small extracts only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).csv(path)


def write_json(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").json(path)


def write_files(df: DataFrame, path: str, file_format: str) -> None:
    if file_format == CSV:
        write_csv(df, path)
    elif file_format == JSON:
        write_json(df, path)
    else:
        raise ValueError(f"unsupported file format {file_format!r}")
