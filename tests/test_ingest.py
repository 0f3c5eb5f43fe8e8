"""Landing, streams, exchange rates and schema changes: nothing is lost or mixed up."""

import json
import os
from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.metadata import Metadata, TableConfig
from layerloom.operators.keys import keep_latest
from layerloom.operators.rules import WARNING, Rule
from layerloom.operators.validate import failure_counts
from layerloom.plans import gold, silver
from layerloom.plans.ingest import Sources, land, load_bronze
from layerloom.plans.lake import BRONZE, GOLD, LANDING, SILVER, Lake
from layerloom.plans.silver import load_silver
from layerloom.sources import files
from layerloom.streaming import files as streaming

DAY = date(2024, 5, 3)


def run(batch: str) -> RunContext:
    return RunContext("R", batch, datetime(2024, 5, 3, 9), DAY)


def config(name: str) -> TableConfig:
    return Metadata().table(name)


def test_rates_keep_every_pair_and_its_latest_day(spark, tmp_path):
    folder = tmp_path / "src" / "exchange_rates"
    folder.mkdir(parents=True)
    answers = [
        (1, "USD", {"INR": 83.0, "EUR": 0.91}),
        (2, "USD", {"INR": 84.0, "EUR": 0.92}),
        (1, "GBP", {"INR": 105.0, "EUR": 1.17}),
    ]
    for i, (day, base, quotes) in enumerate(answers):
        path = folder / f"{i}.json"
        path.write_text(json.dumps({"base_code": base, "conversion_rates": quotes}))
        saved = datetime(2024, 5, day, 12, tzinfo=timezone.utc).timestamp()
        os.utime(path, (saved, saved))
    lake = Lake(spark, str(tmp_path / "lake"))
    rates = lake.metadata.table("exchange_rates")
    land(lake, rates, Sources(str(tmp_path / "src")), run("b1"))
    load_bronze(lake, rates, run("b1"))
    load_silver(lake, rates, run("b1"))
    gold.load_dimension(lake, rates, "exchange_rate_dim", run("b1"))
    found = lake.read(GOLD, "exchange_rate_dim").select(
        "BaseCurrency", "TargetCurrency", F.col("ExchangeRate").cast("double"), "RateDate"
    )
    assert sorted(map(tuple, found.collect())) == [
        ("GBP", "EUR", 1.17, date(2024, 5, 1)),
        ("GBP", "INR", 105.0, date(2024, 5, 1)),
        ("USD", "EUR", 0.92, date(2024, 5, 2)),
        ("USD", "INR", 84.0, date(2024, 5, 2)),
    ]


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_line_breaks_survive_landing(spark, tmp_path):
    values = [(1, "one\ntwo, \"three\""), (2, "plain")]
    (tmp_path / "src").mkdir()
    source = replace(config("products"), file_format="parquet")
    spark.createDataFrame(values, "ProductID int, ProductName string").write.parquet(str(tmp_path / "src" / "products"))
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = files.read_files(spark, str(tmp_path / "src" / "products"), "parquet")
    lake.write(rows, LANDING, "products", run("b1"), table_format="csv", options={"header": True})
    found = lake.read(LANDING, "products").collect()
    assert sorted((int(r.ProductID), r.ProductName) for r in found) == values
    assert source.file_format == "parquet"


def _customers(path, ids):
    lines = [f"{i},N{i},2024-05-01 00:00:00" for i in ids]
    path.write_text("CustomerID,CustomerName,LastUpdated\n" + "\n".join(lines) + "\n")


COLUMNS = ["CustomerID", "CustomerName", "LastUpdated"]


def _stream(lake, folder, checkpoint):
    query = streaming.ingest_files(
        lake, lake.metadata.table("customers"), str(folder), COLUMNS, run("x"), str(checkpoint)
    )
    query.awaitTermination()


def _ids(lake, layer):
    return sorted(int(r.CustomerID) for r in lake.read_batches(layer, "customers").collect())


def test_two_streams_and_a_failure_lose_nothing(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    for name, ids in (("one", [1]), ("two", [2])):
        (tmp_path / name).mkdir()
        _customers(tmp_path / name / "a.csv", ids)
    _stream(lake, tmp_path / "one", tmp_path / "c1")
    _stream(lake, tmp_path / "two", tmp_path / "c2")
    assert _ids(lake, SILVER) == [1, 2]

    # A failure between bronze and silver, then another batch, then the replay.
    _customers(tmp_path / "one" / "b.csv", [3])
    with monkeypatch.context() as patch:
        def fail(*args, **kwargs):
            raise RuntimeError("lost")

        patch.setattr(streaming, "load_silver", fail)
        with pytest.raises(Exception):
            _stream(lake, tmp_path / "one", tmp_path / "c1")
    _customers(tmp_path / "two" / "b.csv", [4])
    _stream(lake, tmp_path / "two", tmp_path / "c2")
    _stream(lake, tmp_path / "one", tmp_path / "c1")
    assert _ids(lake, BRONZE) == [1, 2, 3, 4]
    assert _ids(lake, SILVER) == [1, 2, 3, 4]
    stamps = {r[0] for r in lake.read_batches(SILVER, "customers").select("_ProcessedTimestamp").collect()}
    assert len(stamps) == 4


def test_batches_whose_types_differ_are_read(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    batches = [("1", "int"), ("2", "bigint"), ("'no number'", "string"), ("2.5", "decimal(4,2)")]
    for i, (value, kind) in enumerate(batches):
        rows = spark.sql(f"select cast({value} as {kind}) as v, {i} as n")
        lake.write(rows, BRONZE, "t", run(f"b{i}"))
    found = {r.n: r.v for r in lake.read_batches(BRONZE, "t").collect()}
    assert found == {0: "1", 1: "2", 2: "no number", 3: "2.50"}
    assert [c[0][1] for _, c in lake.schema_history(BRONZE, "t")] == ["RETYPED"] * 3


def test_long_error_messages_are_kept_whole(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    broken = spark.range(1).select(F.raise_error(F.lit("x" * 5000)).alias("v"))
    with pytest.raises(Exception):
        lake.write(broken, BRONZE, "t", run("b"))
    assert "x" * 5000 in lake.audit_log().first()["error_message"]


def test_rejects_of_all_batches_are_shown(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    orders = lake.metadata.table("orders")
    for i in range(2):
        rows = spark.createDataFrame([(str(i), None)], "OrderID string, CustomerID string")
        lake.write(rows, BRONZE, "orders", run(f"b{i}"))
        load_silver(lake, orders, run(f"b{i}"))
    assert silver.rejected_rows(lake, orders).count() == 2


def test_rows_without_a_key_are_all_kept(spark):
    rows = [(None, 1), (None, 2), (3, 1), (3, 2)]
    found = keep_latest(spark.createDataFrame(rows, "k int, v int"), ["k"], ["v"])
    assert sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r[1])) == [(3, 2), (None, 1), (None, 2)]


def test_unique_rules_are_counted(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    found = failure_counts(rows, [Rule("k", "UNIQUE", WARNING)], DAY, "t").first()
    assert (found.checked, found.failed) == (4, 2)
