"""Passing, violating and NULL values for every rule."""

import logging
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.functions.columns import typed
from layerloom.operators.rules import WARNING, Rule, rule_names, violation
from layerloom.operators.validate import (
    failure_counts,
    flag_uncastable,
    mark,
    rejected_rows,
    valid_rows,
    violations_of,
    with_copies,
)

AS_OF = date(2024, 5, 1)
RUN = RunContext("r", "b", datetime(2024, 5, 1, 9), AS_OF)


def rejected(spark, values, kind, rule):
    """Which of the values violate the rule."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    bad = {r["i"] for r in violations_of(df, rule, AS_OF).collect()}
    return [v for i, v in enumerate(values) if i in bad]


@pytest.mark.parametrize(
    ("rule", "kind", "passing", "violating"),
    [
        ("NOT_EMPTY", "string", ["a", " a "], ["", "   "]),
        ("POSITIVE_NUMBER", "double", [0.01, 1.0], [0.0, -1.0]),
        ("VALID_EMAIL", "string", ["a.b1@gmail.com"], ["a@b", "@x.com", "a b@x.com", ""]),
        ("VALID_PHONE", "string", ["9123456789"], ["912345678", "91234567890", "+919123456"]),
        ("VALID_COUNTRY", "string", ["India", "UK"], ["india", "France"]),
        ("VALID_CATEGORY", "string", ["Furniture"], ["Fashion", "Groceries"]),
        ("VALID_PRODUCT_STATUS", "string", ["Active", "Inactive"], ["Retired"]),
        ("VALID_CURRENCY", "string", ["JPY"], ["CHF"]),
        ("NOT_FUTURE_DATE", "date", [AS_OF], [date(2024, 5, 2)]),
        ("VALID_DOB", "date", [date(2024, 4, 30)], [AS_OF]),
        (
            "NOT_FUTURE_DATE",
            "timestamp_ntz",
            [datetime(2024, 5, 1)],
            [datetime(2024, 5, 1, 0, 0, 1)],
        ),
    ],
)
def test_one_column_rules(spark, rule, kind, passing, violating):
    values = [*passing, *violating, None]
    assert rejected(spark, values, kind, Rule("c", rule)) == violating


def test_not_null_is_the_only_rule_null_violates(spark):
    assert rejected(spark, ["a", None], "string", Rule("c", "NOT_NULL")) == [None]


def test_not_future_against_the_clock(spark):
    rule = Rule("c", "NOT_FUTURE_DATE", args={"now": RUN.run_ts, "midnight": False})
    values = [datetime(2024, 5, 1, 8), datetime(2024, 5, 1, 10)]
    assert rejected(spark, values, "timestamp_ntz", rule) == values[1:]
    # The run's clock counts by itself, midnight if asked for, and a time given as text.
    df = spark.createDataFrame([(v,) for v in values], "c timestamp_ntz")
    marked = rejected_rows(mark(df, [Rule("c", "NOT_FUTURE_DATE")], RUN), RUN)
    assert [r["c"] for r in marked.collect()] == values[1:]
    midnight = Rule("c", "NOT_FUTURE_DATE", args={"midnight": True})
    assert rejected(spark, values, "timestamp_ntz", midnight) == values
    late = Rule("c", "NOT_FUTURE_DATE", args={"now": "2024-05-01 11:00:00"})
    assert rejected(spark, values, "timestamp_ntz", late) == []


def test_allowed_values_are_an_argument(spark):
    rule = Rule("c", "VALID_CATEGORY", args={"allowed": ["Fashion"]})
    assert rejected(spark, ["Fashion", "Books", None], "string", rule) == ["Books"]


@pytest.mark.parametrize(
    ("rule", "schema", "rows", "violating"),
    [
        ("VALID_DISCOUNT", "Discount int, UnitPrice int", [(5, 5), (6, 5), (None, 5), (6, None)], [(6, 5)]),
        ("SELL_PRICE_GE_COST", "SellingPrice int, UnitCost int", [(5, 5), (4, 5), (None, 5)], [(4, 5)]),
        (
            "SHIP_AFTER_ORDER",
            "ShipDate timestamp_ntz, OrderDate timestamp_ntz",
            [
                (datetime(2024, 1, 1), datetime(2024, 1, 1)),
                (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1)),
                (None, datetime(2024, 1, 1)),
            ],
            [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1))],
        ),
    ],
)
def test_two_column_rules(spark, rule, schema, rows, violating):
    df = spark.createDataFrame(rows, schema)
    found = violations_of(df, Rule(df.columns[0], rule), AS_OF)
    assert [tuple(r) for r in found.collect()] == violating


def test_order_total_tolerates_exactly_one(spark):
    rows = [("at", 2, "10.00", "1.00", "20.00"), ("past", 2, "10.00", "1.00", "20.01")]
    df = spark.createDataFrame(
        rows, "n string, Quantity int, UnitPrice string, Discount string, TotalAmount string"
    ).select(
        "n",
        "Quantity",
        *[F.col(c).cast("decimal(18,2)") for c in ("UnitPrice", "Discount", "TotalAmount")],
    )
    found = violations_of(df, Rule("TotalAmount", "VALID_ORDER_TOTAL"), AS_OF)
    assert [r["n"] for r in found.collect()] == ["past"]
    percent = Rule(
        "TotalAmount",
        "VALID_ORDER_TOTAL",
        args={"expected": "Quantity * UnitPrice * (1 - Discount / 100)"},
    )
    assert violations_of(df, percent, AS_OF).count() == 0


def test_castable(spark):
    rule = Rule("c", "CASTABLE", args={"type": "INT"})
    values = ["1", " 2 ", "x", "", "3.5", "99999999999", None]
    assert rejected(spark, values, "string", rule) == ["x", "", "3.5", "99999999999"]


def test_unique_counts_copies(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    counted = with_copies(df, ["k"])
    assert sorted(r["k"] for r in violations_of(counted, Rule("k", "UNIQUE"), AS_OF).collect()) == [1, 1]


def test_unique_and_castable_while_marking(spark):
    rows = [("1", "a", "9"), ("1", "b", "x"), ("2", "b", None), ("2", "b", "7")]
    raw = spark.createDataFrame(rows, "k string, l string, n string")
    rules = [Rule("k", "UNIQUE", args={"keys": ["k", "l"]}), Rule("n", "CASTABLE")]
    flagged, bound = flag_uncastable(raw, rules, {"n": "INT"})
    marked = mark(typed(flagged, {"n": "INT"}), bound, RUN)
    assert marked.columns == ["k", "l", "n", "_FailedRules", "_IsRejected", "_ProcessedTimestamp"]
    found = sorted((r["k"], r["l"], str(r["n"]), r["_FailedRules"]) for r in marked.collect())
    assert found == [
        ("1", "a", "9", ""),
        ("1", "b", "None", "n:CASTABLE"),
        ("2", "b", "7", "k:UNIQUE"),
        ("2", "b", "None", "k:UNIQUE"),
    ]


def test_unknown_rule_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown data-quality rule"):
        violation(spark.range(1), Rule("id", "NO_SUCH_RULE"), AS_OF)


@pytest.mark.parametrize("rule", ["NOT_NULL", "VALID_DISCOUNT", "SHIP_AFTER_ORDER"])
def test_missing_columns_skip_the_rule_with_a_warning(spark, caplog, rule):
    with caplog.at_level(logging.WARNING):
        assert violation(spark.range(1), Rule("gone", rule), AS_OF) is None
    assert "columns missing" in caplog.text


def test_all_rules_are_listed():
    assert {"NOT_NULL", "UNIQUE", "CASTABLE", "VALID_CURRENCY"} <= set(rule_names())


RULES = [Rule("a", "POSITIVE_NUMBER"), Rule("b", "NOT_EMPTY", WARNING), Rule("gone", "NOT_NULL")]
ROWS = [(1, "x"), (-1, "x"), (1, ""), (-1, ""), (None, None)]


def test_split_is_complete_and_names_the_rules(spark):
    marked = mark(spark.createDataFrame(ROWS, "a int, b string"), RULES, RUN)
    valid, reject = valid_rows(marked, RUN), rejected_rows(marked, RUN)
    assert sorted(map(str, valid.select("a", "b").collect())) == sorted(
        ["Row(a=1, b='x')", "Row(a=None, b=None)"]
    )
    assert {r["_FailedRules"] for r in reject.collect()} == {
        "a:POSITIVE_NUMBER",
        "b:NOT_EMPTY",
        "a:POSITIVE_NUMBER;b:NOT_EMPTY",
    }
    assert "_FailedRules" not in valid.columns
    assert {r["_ProcessedTimestamp"] for r in reject.collect()} == {RUN.run_ts}


def test_warnings_do_not_reject_when_severity_counts(spark):
    marked = mark(spark.createDataFrame(ROWS, "a int, b string"), RULES, RUN, severity_aware=True)
    warned = marked.where("a = 1 and b = ''").first()
    assert not warned["_IsRejected"] and warned["_FailedRules"] == "b:NOT_EMPTY"
    assert marked.where("_IsRejected").count() == 2


def test_no_rules_reject_nothing(spark):
    marked = mark(spark.createDataFrame(ROWS, "a int, b string"), [], RUN)
    assert marked.where("_IsRejected").count() == 0


def test_failure_counts(spark):
    df = spark.createDataFrame(ROWS, "a int, b string")
    found = {r["column_name"]: r for r in failure_counts(df, RULES, AS_OF, "t").collect()}
    assert set(found) == {"a", "b"}
    assert found["a"]["failed"] == 2 and found["b"]["severity"] == WARNING
    assert found["b"]["checked"] == len(ROWS)
