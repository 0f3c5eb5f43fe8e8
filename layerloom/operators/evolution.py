"""Schema evolution: merge frames of different shape and report the difference."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADDED, MISSING, RETYPED = "ADDED", "MISSING", "RETYPED"


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column only one side has is NULL on the other, and one
    whose type changed gets a type that holds both."""
    return widened([old, new])


# Types of which each holds all values of those before it.
_NUMBERS = ["tinyint", "smallint", "int", "bigint"]


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """A type that holds all values of the given ones; text if there is no closer one."""
    found = list(dict.fromkeys(types))
    names = [t.simpleString() for t in found]
    if len(found) == 1:
        return found[0]
    if all(n in _NUMBERS for n in names):
        return max(found, key=lambda t: _NUMBERS.index(t.simpleString()))
    if all(isinstance(t, T.DecimalType) for t in found):
        scale = max(t.scale for t in found)
        whole = max(t.precision - t.scale for t in found)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if all(n in ("float", "double") for n in names):
        return T.DoubleType()
    return T.StringType()


def widened(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of batches whose columns came, went or changed their type."""
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for f in frame.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)
    target = {name: common_type(types) for name, types in kinds.items()}
    result = None
    for frame in frames:
        changed = {f.name: F.col(f.name).cast(target[f.name]) for f in frame.schema.fields if f.dataType != target[f.name]}
        frame = frame.withColumns(changed) if changed else frame
        result = frame if result is None else result.unionByName(frame, allowMissingColumns=True)
    return result


def schema_changes(old: T.StructType, new: T.StructType) -> list[tuple]:
    """(column, change, old type, new type) for every difference."""
    before = {f.name: f.dataType.simpleString() for f in old.fields}
    after = {f.name: f.dataType.simpleString() for f in new.fields}
    changes = []
    for name in dict.fromkeys([*before, *after]):
        was, becomes = before.get(name), after.get(name)
        if was != becomes:
            kind = ADDED if was is None else MISSING if becomes is None else RETYPED
            changes.append((name, kind, was, becomes))
    return changes


def schema_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per column that was added, went missing or changed its type."""
    return new.sparkSession.createDataFrame(
        schema_changes(old.schema, new.schema),
        "column_name string, change string, old_type string, new_type string",
    )
