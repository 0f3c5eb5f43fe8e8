"""Dense keys, keep-latest, and versioned dimensions under random changes."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.context import RunContext
from layerloom.operators import scd
from layerloom.operators.keys import dense_key, distinct_keys, keep_latest

SCHEMA = "k int, v string, _RecordHash string"
DAY = datetime(2024, 1, 1)


def run_on(n: int) -> RunContext:
    when = DAY + timedelta(days=n)
    return RunContext("r", f"b{n}", when, when.date())


def source(spark, values: dict):
    return spark.createDataFrame([(k, v, v) for k, v in values.items()], SCHEMA)


def rows_of(df):
    columns = ["k", "v", "_StartDate", "_EndDate", "_IsCurrent", "CustomerSK"]
    return sorted(map(tuple, df.select(*columns).collect()), key=lambda r: r[-1])


@pytest.mark.parametrize("kind", ["string", "bigint", "date"])
def test_dense_key_equals_row_number(spark, kind):
    key = F.lpad(F.col("id").cast("string"), 6, "0")
    if kind == "bigint":
        key = F.col("id") * 7 - 900
    if kind == "date":
        key = F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int"))
    df = spark.range(3000).select(key.alias("k")).repartition(7)
    ours = dense_key(df, ["k"], "sk", start=10)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k")) + 10)
    assert ours.exceptAll(expected).count() == 0 and ours.count() == 3000


def test_dense_key_across_many_partitions(spark):
    """With partitions kept apart, offsets are really used."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 31 % 5003).alias("k"))
        ours = dense_key(df, ["k"], "sk")
        assert len(ours.inputFiles()) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k")))
    assert ours.exceptAll(expected).count() == 0


def test_dense_key_of_nothing(spark):
    out = dense_key(spark.range(0), ["id"], "sk", start=5)
    assert out.count() == 0 and out.columns == ["id", "sk"]


def test_dense_key_with_a_frequent_value_and_tie_breaker(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), "id")
    out = dense_key(df, ["k", "id"], "sk").orderBy("sk").collect()
    assert [(r["k"], r["id"]) for r in out] == sorted((i % 3, i) for i in range(2000))
    assert [r["sk"] for r in out] == list(range(1, 2001))


def test_keep_latest(spark):
    rows = [(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    out = keep_latest(df, ["k"], ["t"])
    assert out.columns == df.columns
    assert sorted((r["k"] or 0, r["v"]) for r in out.collect()) == [(0, "e"), (0, "f"), (1, "b"), (2, "d")]
    assert distinct_keys(df, ["k"]).count() == 3


def test_upsert_adds_columns(spark):
    old = spark.createDataFrame([(1, 1), (2, 1)], "k int, t int")
    new = spark.createDataFrame([(2, 2, "x")], "k int, t int, extra string")
    out = sorted(tuple(r) for r in scd.upsert(old, new, ["k"], ["t"]).orderBy("k").collect())
    assert out == [(1, 1, None), (2, 2, "x")]


def test_change_sequence(spark):
    """A key that changes twice keeps both of its end dates."""
    dim = scd.initial_versions(source(spark, {1: "a", 2: "a", 3: "a"}), "k", run_on(0))
    dim = scd.merge_versions(dim, source(spark, {1: "b", 2: "a", 4: "a"}), "k", run_on(1))
    dim = scd.merge_versions(dim, source(spark, {1: "c", 2: "a"}), "k", run_on(2))
    d = [DAY + timedelta(days=n) for n in range(3)]
    assert [r for r in rows_of(dim) if r[0] == 1] == [
        (1, "a", d[0], d[1], False, 1),
        (1, "b", d[1], d[2], False, 4),
        (1, "c", d[2], None, True, 6),
    ]
    assert [r for r in rows_of(dim) if r[0] in (2, 3, 4)] == [
        (2, "a", d[0], None, True, 2),
        (3, "a", d[0], None, True, 3),
        (4, "a", d[1], None, True, 5),
    ]


def test_missing_keys_can_be_closed(spark):
    dim = scd.initial_versions(source(spark, {1: "a", 2: "a"}), "k", run_on(0))
    dim = scd.merge_versions(dim, source(spark, {1: "a"}), "k", run_on(1), close_missing=True)
    assert [(r[0], r[4]) for r in rows_of(dim)] == [(1, True), (2, False)]


def test_null_hash_counts_as_a_change(spark):
    dim = scd.initial_versions(source(spark, {1: None, 2: None}), "k", run_on(0))
    changed = scd.changed_rows(dim, source(spark, {1: "x", 2: None}), "k", run_on(1))
    assert [r["k"] for r in changed.collect()] == [1]


def test_classes(spark):
    dim = scd.initial_versions(source(spark, {1: "a", 2: "a", 3: "a"}), "k", run_on(0))
    found = scd.classify(dim, source(spark, {1: "a", 2: "b", 9: "a"}), "k", run_on(1)).collect()
    assert dict(map(tuple, found)) == {1: "SAME", 2: "CHANGED", 3: "MISSING", 9: "NEW"}


def test_new_columns_are_kept(spark):
    dim = scd.initial_versions(source(spark, {1: "a"}), "k", run_on(0))
    wider = source(spark, {1: "b"}).withColumn("extra", F.lit("e"))
    merged = scd.merge_versions(dim, wider, "k", run_on(1)).orderBy("CustomerSK").collect()
    assert [r["extra"] for r in merged] == [None, "e"]


snapshots = st.lists(
    st.dictionaries(st.integers(1, 6), st.sampled_from("abc"), min_size=0, max_size=6),
    min_size=2,
    max_size=3,
)


def expected_versions(days):
    """The same history, kept by hand."""
    versions, top = [], 0
    for n, snapshot in enumerate(days):
        opened = []
        for k, v in sorted(snapshot.items()):
            current = next((x for x in versions if x["k"] == k and x["to"] is None), None)
            if current is None or current["v"] != v:
                if current:
                    current["to"] = n
                opened.append({"k": k, "v": v, "from": n, "to": None})
        for x in opened:
            top += 1
            x["sk"] = top
        versions += opened
    day = lambda n: None if n is None else DAY + timedelta(days=n)
    rows = [
        (x["k"], x["v"], day(x["from"]), day(x["to"]), x["to"] is None, x["sk"]) for x in versions
    ]
    return sorted(rows, key=lambda r: r[-1])


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(days=snapshots)
def test_history_equals_the_one_kept_by_hand(spark, days):
    dim = scd.initial_versions(source(spark, days[0]), "k", run_on(0))
    for n, snapshot in enumerate(days[1:], 1):
        dim = scd.merge_versions(dim, source(spark, snapshot), "k", run_on(n))
    found = rows_of(dim)
    assert found == expected_versions(days)
    again = scd.merge_versions(dim, source(spark, days[-1]), "k", run_on(len(days)))
    assert rows_of(again) == found
