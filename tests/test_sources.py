"""File formats, rates, generated tables, incremental loads, streams, database options."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.metadata import Metadata, TableConfig
from layerloom.operators.incremental import load_slice, next_mark
from layerloom.plans.lake import BRONZE, SILVER, Lake
from layerloom.sources import files, jdbc, rates, retail
from layerloom.streaming.files import ingest_files

DAY = date(2024, 5, 1)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'q"', "")], "id int, t string, e string")
    files.write_csv(df, str(tmp_path / "t"), single_file=True)
    back = files.read_raw(spark, str(tmp_path / "t"), "csv")
    assert back.dtypes == [("id", "string"), ("t", "string"), ("e", "string")]
    # An empty text does not survive CSV: it comes back as NULL.
    assert sorted(map(tuple, back.collect())) == [("1", "a,b", None), ("2", 'q"', None)]
    assert len(list((tmp_path / "t").glob("*.csv"))) == 1


def test_csv_without_header(spark, tmp_path):
    files.write_csv(spark.range(2), str(tmp_path / "t"), header=False, single_file=True)
    assert next((tmp_path / "t").glob("*.csv")).read_text().split() == ["0", "1"]


def test_json_keeps_literals(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"b": 1.10, "a": "x", "c": true}\n{"b": 12345678.9}\n')
    found = files.read_raw(spark, str(tmp_path), "json")
    assert found.columns == ["a", "b", "c"]
    assert {r["b"] for r in found.collect()} == {"1.10", "12345678.9"}
    declared = files.read_raw(spark, str(tmp_path), "json", ["b", "a"])
    assert declared.columns == ["b", "a"]
    files.write_json(declared, str(tmp_path / "out"), single_file=True)
    assert files.read_files(spark, str(tmp_path / "out"), "json").count() == 2


def test_other_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        files.read_raw(spark, "x", "xml")
    with pytest.raises(ValueError, match="unsupported"):
        files.write_files(spark.range(1), "x", "xml")
    spark.range(3).write.orc(str(tmp_path / "o"))
    assert files.read_files(spark, str(tmp_path / "o"), "orc").count() == 3


def test_unknown_source_type_is_refused():
    known = Metadata().table("orders")
    with pytest.raises(ValueError, match="unknown source type"):
        TableConfig(**{**known.__dict__, "source_type": "REST_API"})


def test_rate_answers(spark, tmp_path):
    (tmp_path / "1.json").write_text(
        json.dumps({"base_code": "USD", "conversion_rates": {"INR": 83.1, "USD": 1}}, indent=2)
    )
    found = rates.read_answers(spark, str(tmp_path), F.lit(DAY))
    assert found.columns == rates.RATE_COLUMNS
    assert sorted(map(tuple, found.collect())) == [("USD", "INR", 83.1, DAY), ("USD", "USD", 1.0, DAY)]


def test_generated_tables_repeat_and_agree(spark):
    products = retail.products(spark, 60)
    customers = retail.customers(spark, DAY, 80)
    orders = retail.orders(spark, DAY, 500, 80, 60)
    assert products.exceptAll(retail.products(spark, 60)).count() == 0
    assert (products.count(), customers.count(), orders.count()) == (60, 80, 500)
    joined = orders.join(products, "ProductID").join(customers, "CustomerID")
    assert joined.count() == 500
    wrong = joined.where(
        "UnitPrice <> SellingPrice or SellingPrice < CostPrice or ShipDate <= OrderDate "
        "or Quantity not between 1 and 10 or not Phone rlike '^9[0-9]{9}$' "
        "or abs(TotalAmount - Quantity * UnitPrice * (1 - Discount / 100)) > 0.01"
    )
    assert wrong.count() == 0
    assert {r[0] for r in products.select("Category").distinct().collect()} == set(retail.CATEGORIES)
    for row in products.select("Category", "ProductName").distinct().collect():
        assert row["ProductName"] in retail.CATEGORIES[row["Category"]]
    assert dict(orders.dtypes)["Discount"] == "double"


def test_load_types(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "t int")
    mark = F.lit(2)
    values = lambda d: sorted((r["t"] for r in d.collect()), key=lambda v: v or 0)
    assert values(load_slice(df, "FULL", None, mark)) == [None, 1, 2, 3]
    assert values(load_slice(df, "INCREMENTAL", "t", None)) == [None, 1, 2, 3]
    assert values(load_slice(df, "INCREMENTAL", "t", mark)) == [3]
    assert values(load_slice(df, "INCREMENTAL", "t", mark, inclusive=True)) == [2, 3]
    assert values(load_slice(df, "INCREMENTAL", "t", mark, undated=True)) == [None, 3]
    with pytest.raises(ValueError, match="unknown load type"):
        load_slice(df, "SOMETIMES", "t", mark)
    with pytest.raises(ValueError, match="watermark column"):
        load_slice(df, "INCREMENTAL", None, mark)
    assert tuple(next_mark(df, "t", mark).first()) == (1, 3)
    assert tuple(next_mark(df, "t", F.lit(9)).first()) == (0, 9)


def test_metadata_round_trip(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.save_metadata()
    assert Lake.open(spark, str(tmp_path)).metadata == Metadata()
    names = [t.table_name for t in Metadata().active_tables()]
    assert names == ["products", "customers", "orders", "exchange_rates"]


def test_schema_history(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    frames = [spark.range(1), spark.range(1), spark.range(1).withColumn("extra", F.lit("x"))]
    for n, df in enumerate(frames):
        lake.write(df, BRONZE, "t", RunContext("r", f"b{n}", datetime(2024, 5, 1), DAY))
    assert lake.schema_history(BRONZE, "t") == [("b2", [("extra", "ADDED", None, "string")])]
    assert sorted(map(str, lake.read_batches(BRONZE, "t").collect())) == [
        "Row(id=0, extra='x')",
        "Row(id=0, extra=None)",
        "Row(id=0, extra=None)",
    ]


def test_table_format_is_chosen_per_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    run = RunContext("r", "b1", datetime(2024, 5, 1), DAY)
    lake.write(spark.range(3), BRONZE, "t", run, table_format="orc")
    assert list((tmp_path / "bronze" / "t").rglob("*.orc"))
    assert lake.read(BRONZE, "t").count() == 3
    assert lake.last_commit(BRONZE, "t").records_written == 3


def test_stream_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    lake = Lake(spark, str(tmp_path / "lake"))
    config = lake.metadata.table("products")
    products = retail.products(spark, 30)

    def ingest(n):
        run = RunContext("r", "unused", datetime(2024, 5, n), date(2024, 5, n))
        query = ingest_files(
            lake, config, str(folder), products.columns, run, str(tmp_path / "checkpoint")
        )
        query.awaitTermination()
        assert query.exception() is None

    def loaded():
        return lake.read_batches(SILVER, "products").select("ProductID").collect()

    products.where("ProductID <= 10").write.option("header", True).csv(str(folder))
    ingest(1)
    assert len(loaded()) == 10
    products.where("ProductID > 10").write.mode("append").option("header", True).csv(str(folder))
    ingest(2)
    ingest(3)
    assert sorted(r[0] for r in loaded()) == list(range(1, 31))
    assert len(lake.commits(BRONZE, "products")) == 2


class Recorder:
    """Stands for a reader or writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def note(*args, **kwargs):
            if name == "option":
                self.told[args[0]] = args[1]
            elif name == "options":
                self.told.update(kwargs)
            else:
                self.told[name] = args[0] if args else True
            return self

        return note


def test_database_options():
    """What is passed on to the database source; no database is opened."""

    class Session:
        read = Recorder()

    split = jdbc.Split("id", 1, 1000, 16)
    jdbc.read_table(Session, "dbo.Customers", {"url": "jdbc:x"}, split)
    assert Session.read.told == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "dbo.Customers",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "16",
        "load": True,
    }

    class Frame:
        write = Recorder()

    jdbc.write_table(Frame, "dbo.fact", {"url": "jdbc:x"}, connections=8)
    told = Frame.write.told
    assert told["mode"] == "overwrite" and told["truncate"] and told["dbtable"] == "dbo.fact"
