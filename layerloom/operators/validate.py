"""Apply rules to a table: mark, split and summarise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.functions.columns import parsed
from layerloom.operators.rules import ERROR, Rule, violation
from layerloom.storage import staged

LABEL_SEPARATOR = ";"
# Columns that live only while rules are checked.
_TEMPORARY = "__rule_"


def with_copies(df: DataFrame, keys: Sequence[str], name: str = "_Copies") -> DataFrame:
    """Add how many rows share the key (1 for a unique row or a NULL key).

    Keys, which seldom repeat, are shuffled before they are counted, into as many
    partitions as the session has: a task that counted what it reads of the table,
    or small partitions put together, would hold all those keys in memory. The
    ones that repeat are written down. Their size is then known: while they are
    few, they are broadcast and the wide rows are not shuffled at all. Beyond that,
    a very frequent key is still a single row on that side, and the wide side of
    the join can be split by adaptive execution.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*keys).repartition(parts, *keys)
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    repeated = staged(counts.where(F.col(name) > 1), "copies")
    return df.join(repeated, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(1)))


def _failed_labels(df: DataFrame, rules: Sequence[Rule], run: RunContext):
    found = [(r, violation(df, r, run.as_of, run.run_ts)) for r in rules]
    labels = [F.when(v, F.lit(r.label)) for r, v in found if v is not None]
    return F.concat_ws(LABEL_SEPARATOR, *labels) if labels else F.lit("")


def _with_all_copies(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, list[Rule]]:
    """Count copies for every UNIQUE rule and point the rule to its count."""
    bound = []
    for i, r in enumerate(rules):
        keys = r.args.get("keys") or [r.column]
        if r.name == "UNIQUE" and set(keys) <= set(df.columns):
            df = with_copies(df, keys, f"{_TEMPORARY}copies_{i}")
            r = replace(r, args={**r.args, "copies": f"{_TEMPORARY}copies_{i}"})
        bound.append(r)
    return df, bound


def flag_uncastable(
    raw: DataFrame, rules: Sequence[Rule], types: Mapping[str, str]
) -> tuple[DataFrame, list[Rule]]:
    """Set a flag for every CASTABLE rule while the column is still text, and
    point the rule to it. The type is the declared one unless the rule names one."""
    bound, flags = [], {}
    for i, r in enumerate(rules):
        if r.name == "CASTABLE" and r.column in raw.columns:
            name = f"{_TEMPORARY}uncastable_{i}"
            target = r.args.get("type") or types.get(r.column, "string")
            text = F.col(r.column)
            flags[name] = text.isNotNull() & parsed(text, target).isNull()
            r = replace(r, args={**r.args, "failed": name})
        bound.append(r)
    return (raw.withColumns(flags) if flags else raw), bound


def mark(
    df: DataFrame,
    rules: Sequence[Rule],
    run: RunContext,
    *,
    severity_aware: bool = False,
) -> DataFrame:
    """Add the violated rules, the rejected flag and the processing time.

    All rules are checked in one projection. Every violated rule rejects its
    row; with ``severity_aware`` only rules of severity ERROR do, and warnings
    are just recorded.
    """
    names = run.columns
    df, rules = _with_all_copies(df, rules)
    failed = {names.failed_rules: _failed_labels(df, rules, run)}
    rejecting = names.failed_rules
    if severity_aware:
        rejecting = f"{_TEMPORARY}errors"
        errors = [r for r in rules if r.severity == ERROR]
        failed[rejecting] = _failed_labels(df, errors, run)
    marked = df.withColumns(failed)
    result = marked.withColumns(
        {names.is_rejected: F.col(rejecting) != "", names.processed_at: run.timestamp()}
    )
    return result.drop(*[c for c in result.columns if c.startswith(_TEMPORARY)])


def valid_rows(marked: DataFrame, run: RunContext) -> DataFrame:
    """The rows that passed, without the list of violated rules."""
    return marked.where(~F.col(run.columns.is_rejected)).drop(run.columns.failed_rules)


def rejected_rows(marked: DataFrame, run: RunContext) -> DataFrame:
    return marked.where(run.columns.is_rejected)


def violations_of(df: DataFrame, check: Rule, as_of: date) -> DataFrame:
    """Only the rows that violate one rule."""
    found = violation(df, check, as_of)
    return df.where(F.lit(False) if found is None else found)


def failure_counts(df: DataFrame, rules: Sequence[Rule], as_of: date, table: str) -> DataFrame:
    """Rows checked and violations, one result row per applicable rule.

    A single scan with one partial counter per rule; only the counters, not
    the rows, are shuffled. UNIQUE rules count the copies of their keys first.
    """
    df, rules = _with_all_copies(df, rules)
    found = [(r, violation(df, r, as_of)) for r in rules]
    found = [(r, v) for r, v in found if v is not None]
    if not found:
        raise ValueError(f"no rule applies to {table}")
    counted = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(v).alias(f"rule_{i}") for i, (_, v) in enumerate(found)],
    )
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.name).alias("rule"),
            F.lit(r.severity).alias("severity"),
            F.col("checked"),
            F.col(f"rule_{i}").alias("failed"),
        )
        for i, (r, _) in enumerate(found)
    ]
    return counted.select(F.inline(F.array(*entries)))
