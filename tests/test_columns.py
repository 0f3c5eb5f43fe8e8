"""Names, casts, hashes, updates and money."""

import hashlib
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerloom.context import RunContext, TechnicalColumns
from layerloom.functions import columns as cols
from layerloom.functions import money
from layerloom.operators.evolution import evolve_union, schema_difference

RUN = RunContext("r", "b", datetime(2024, 5, 1, 9), date(2024, 5, 1))
SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_names_are_cleaned(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "c.d", "é-1"])
    assert cols.sanitize_columns(df).columns == ["a_b", "c_d", "__1"]


def test_names_that_collide_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "A-b"])
    with pytest.raises(ValueError, match="both become"):
        cols.sanitize_columns(df)


@pytest.mark.parametrize("kind", ["INT", "BIGINT", "SMALLINT", "DECIMAL(18,2)", "DECIMAL(5,0)"])
def test_parsed_equals_try_cast(spark, kind):
    texts = [
        "1", "-1", "+1", " 1", "1 ", "\t1\n", "\x001", "\x7f1", "1\x85", "1.5", ".5", "5.", "1e3",
        "1E-2", "-.5e+1", "1,000", "", " ", "+", "-", ".", "e", "NaN", "Infinity", "0x10", "1L",
        "1d", "１２", "٣", "99999999999999999999", "-32769", "1 2", " 1", "　1", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t",
        cols.parsed(F.col("t"), kind).alias("ours"),
        F.col("t").try_cast(kind.lower()).alias("plain"),
    )
    assert df.where(~F.col("ours").eqNullSafe(F.col("plain"))).collect() == []


number_like = st.text(alphabet="0123456789+-.eE \t\n\x00\x7f٣xN", max_size=6)


@SLOW
@given(texts=st.lists(number_like, min_size=40, max_size=80))
def test_parsed_equals_try_cast_on_random_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "decimal(18,2)"):
        ours, plain = cols.parsed(F.col("t"), kind), F.col("t").try_cast(kind)
        assert df.where(~ours.eqNullSafe(plain)).collect() == []


def test_typed_leaves_other_columns_and_ignores_missing(spark):
    df = spark.createDataFrame([("1", "x", "2024-02-30")], ["a", "b", "d"])
    out = cols.typed(df, {"a": "INT", "d": "DATE", "gone": "INT"})
    assert out.dtypes == [("a", "int"), ("b", "string"), ("d", "date")]
    assert tuple(out.first()) == (1, "x", None)


def test_hash_matches_its_definition(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    out = df.select(cols.record_hash(df, ["z", "x", "y"])).first()[0]
    assert out == hashlib.sha256(b"3||a||").hexdigest()


def test_hash_refuses_floats_and_unknown_columns(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="float"):
        cols.record_hash(df, ["x"])
    with pytest.raises(ValueError, match="missing"):
        cols.record_hash(df, ["y"])
    hashed = df.select(cols.record_hash(df, ["x"], float_type="decimal(18,2)")).first()[0]
    assert hashed == hashlib.sha256(b"1.00").hexdigest()


def test_length_prefix_tells_separators_apart(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    plain = df.select(cols.record_hash(df, ["x", "y"])).distinct().count()
    safe = df.select(cols.record_hash(df, ["x", "y"], length_prefix=True)).distinct().count()
    assert (plain, safe) == (1, 2)


def test_technical_columns_are_not_business_columns(spark):
    df = cols.stamp_ingested(spark.createDataFrame([(1, "t")], ["id", "BatchID"]), RUN)
    assert cols.business_columns(df, RUN) == ["id"]


def test_technical_names_come_from_configuration():
    names = TechnicalColumns()
    assert TechnicalColumns.from_config(names.to_config()) == names
    renamed = TechnicalColumns.from_config({"BATCH_ID_COLUMN": "_Load"})
    assert renamed.batch_id == "_Load"
    with pytest.raises(ValueError):
        TechnicalColumns.from_config({"NO_SUCH": "x"})


def test_update_where(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    out = cols.update_where(df, F.col("k") == 1, {"v": "new"})
    assert [r["v"] for r in out.collect()] == ["new", "b", "c"]
    with pytest.raises(ValueError):
        cols.update_where(df, F.col("k") == 1, {"gone": 1})


@SLOW
@given(
    groups=st.lists(
        st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=7), min_size=20, max_size=40
    )
)
def test_money_is_exact(spark, groups):
    for scale, kind in ((0, "bigint"), (2, "decimal(18,2)"), (4, "decimal(18,4)"), (4, "double")):
        unit = 10**scale
        rows = [(g, Decimal(c) / unit) for g, parts in enumerate(groups) for c in parts]
        df = spark.createDataFrame(rows, "g int, amount decimal(18,4)")
        df = df.withColumn("amount", F.col("amount").cast(kind))
        sums = df.groupBy("g").agg(
            F.sum(money.exact(df, "amount")).alias("s"), F.count("amount").alias("n")
        )
        mean = money.mean(F.col("s"), F.col("n"), sums.schema["s"].dataType.scale)
        for g, total, mean in sums.select("g", money.total(F.col("s")), mean).collect():
            exact, cent = Decimal(sum(groups[g])) / unit, Decimal("0.01")
            assert total == exact.quantize(cent, ROUND_HALF_UP)
            assert mean == (exact / len(groups[g])).quantize(cent, ROUND_HALF_UP)


def test_amounts_are_rounded_after_they_are_summed(spark):
    df = spark.createDataFrame([(Decimal("0.004"),)] * 3, "amount decimal(18,3)")
    assert df.agg(money.total(F.sum(money.exact(df, "amount")))).first()[0] == Decimal("0.01")


def test_schema_difference_and_union(spark):
    old = spark.createDataFrame([(1, "a")], "id int, gone string")
    new = spark.createDataFrame([(2, 3.0)], "id bigint, extra double")
    found = {r["column_name"]: r["change"] for r in schema_difference(old, new).collect()}
    assert found == {"id": "RETYPED", "gone": "MISSING", "extra": "ADDED"}
    both = evolve_union(old, new).orderBy("id").collect()
    assert [tuple(r) for r in both] == [(1, "a", None), (2, None, 3.0)]
    assert schema_difference(old, old).count() == 0
    text = evolve_union(old, spark.createDataFrame([("x",)], "id string"))
    assert sorted(r["id"] for r in text.collect()) == ["1", "x"]


def test_many_small_doubles_add_up(spark):
    """100,000 amounts of 4e-7 are 0.04: none is rounded away before the sum."""
    df = spark.range(100_000).select(F.lit(4e-7).alias("amount"), F.lit(1).alias("g"))
    summed = df.groupBy("g").agg(F.sum(money.exact(df, "amount")).alias("s"), F.count("amount").alias("n"))
    scale = summed.schema["s"].dataType.scale
    row = summed.select(money.total(F.col("s")).alias("t"), money.mean(F.col("s"), F.col("n"), scale).alias("m")).first()
    assert (row.t, row.m) == (Decimal("0.04"), Decimal("0.00"))
