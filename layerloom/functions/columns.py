"""Column-level operators: names, types, stamps, hashes and keyed updates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.context import RunContext

# Separator and digest size of the record hash.
HASH_SEPARATOR = "||"
HASH_BITS = 256


def sanitize_name(name: str) -> str:
    """Replace every character outside ``[a-zA-Z0-9_]`` with an underscore."""
    return re.sub(r"[^a-zA-Z0-9_]", "_", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns at once; refuse names that become equal.

    Spark resolves names without regard to case, so the check does too.
    """
    names = [sanitize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both become {new!r}")
        seen[new.lower()] = old
    return df.toDF(*names)


def _plain_text(field: T.StructField) -> Column:
    """A column as text. Floats are written without an exponent where that loses nothing."""
    column = F.col(f"`{field.name}`")
    text = column.cast("string")
    if not isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return text
    exact = text.try_cast("decimal(38,18)")
    plain = F.regexp_replace(exact.cast("string"), r"\.?0+$", "")
    same = exact.cast(field.dataType.simpleString()) == column
    return F.when(column == 0, "0").when(same, plain).otherwise(text)


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as a string, in one projection. A float reads the same whatever its size."""
    return df.select(*[_plain_text(f).alias(f.name) for f in df.schema.fields])


# Text that may be a number, with the blanks and control characters a cast trims.
# Decimals may use any Unicode digit. Wider than what a cast accepts, never narrower.
_BLANKS = r"[\x00-\x20\x7F]*"
_WHOLE = rf"^{_BLANKS}[+-]?[0-9]+{_BLANKS}$"
_DECIMAL = rf"^{_BLANKS}[+-]?[\p{{Nd}}.]+([eE][+-]?\p{{Nd}}+)?{_BLANKS}$"
_SHAPES = {
    "tinyint": _WHOLE,
    "smallint": _WHOLE,
    "int": _WHOLE,
    "integer": _WHOLE,
    "bigint": _WHOLE,
    "long": _WHOLE,
    "decimal": _DECIMAL,
}


def parsed(text: Column, target: str) -> Column:
    """Text as another type, NULL where it does not parse.

    For numbers ``try_cast`` raises and catches an exception per bad value,
    about twenty times the cost of a good one. A pattern sorts out hopeless
    text first, so a column full of garbage does not slow the job down.
    """
    target = target.lower()
    shape = _SHAPES.get(target.split("(")[0].strip())
    cast = text.try_cast(target)
    return cast if shape is None else F.when(text.rlike(shape), cast)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns; the others keep their type.

    Text that does not parse becomes NULL instead of failing the job (the
    CASTABLE rule reports it). Listed columns the frame lacks are ignored.
    """
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def cast(name: str) -> Column:
        column = F.col(name)
        if name not in types:
            return column
        target = types[name].lower()
        result = parsed(column, target) if name in strings else column.try_cast(target)
        return result.alias(name)

    return df.select(*[cast(c) for c in df.columns])


def stamp_ingested(df: DataFrame, run: RunContext) -> DataFrame:
    """Add batch id, run id and ingestion time."""
    names = run.columns
    return df.withColumns(
        {
            names.batch_id: F.lit(run.batch_id),
            names.run_id: F.lit(run.run_id),
            names.ingested_at: run.timestamp(),
        }
    )


def stamp_landed(df: DataFrame, run: RunContext) -> DataFrame:
    """Add the two stamps of the landing layer."""
    return df.withColumns({"BatchID": F.lit(run.batch_id), "LandingTimestamp": run.timestamp()})


def _hashable(field: T.StructField, float_type: str | None) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        if float_type is None:
            raise ValueError(
                f"column {field.name!r} is a float: its text form is not stable, "
                "pass float_type='decimal(p,s)'"
            )
        column = column.cast(float_type)
    return column.cast("string")


def record_hash(
    df: DataFrame,
    columns: Sequence[str],
    *,
    float_type: str | None = None,
    length_prefix: bool = False,
) -> Column:
    """SHA-256 over the given business columns, in the given order.

    NULL counts as the empty string. With ``length_prefix`` each value carries
    its length, so that values holding the separator cannot collide.
    """
    fields = {f.name: f for f in df.schema.fields}
    missing = [c for c in columns if c not in fields]
    if missing:
        raise ValueError(f"columns to hash are missing: {missing}")
    parts = [F.coalesce(_hashable(fields[c], float_type), F.lit("")) for c in columns]
    if length_prefix:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), HASH_BITS)


def business_columns(df: DataFrame, run: RunContext, extra: Iterable[str] = ()) -> list[str]:
    """Columns that describe the record itself, not how it was loaded."""
    technical = set(vars(run.columns).values()) | {"BatchID", "LandingTimestamp"} | set(extra)
    return [c for c in df.columns if c not in technical]


def update_where(df: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns on the rows that meet the condition; keep the rest as is."""
    unknown = [c for c in values if c not in df.columns]
    if unknown:
        raise ValueError(f"columns to update are missing: {unknown}")
    return df.withColumns(
        {
            c: F.when(condition, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
            for c, v in values.items()
        }
    )
