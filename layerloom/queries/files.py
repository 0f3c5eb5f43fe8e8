"""Text sources, landing and streams, on files that Spark writes from the given tables."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.metadata import DatatypeConfig, Metadata, TableConfig
from layerloom.operators.incremental import FULL, INCREMENTAL
from layerloom.plans.ingest import Sources, land, landed_rows, load_bronze
from layerloom.plans.lake import SILVER, Lake
from layerloom.plans.silver import OUTCOME, load_silver
from layerloom.queries.registry import query, run_at, table
from layerloom.sources import files
from layerloom.storage import shared_folder
from layerloom.streaming.files import ingest_files


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _text(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column, pattern).alias(column)


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
EVENTS_SQL = """
    select event_id::varchar as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id::varchar as user_id,
           event_type, value::decimal(18,4)::varchar as value
    from events"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,4)").cast("string").alias("value")
    rows = table(spark, sf, "events").select("event_id", _text("ts"), "user_id", "event_type", value)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS])


def _by_header(rows: DataFrame, folder: str) -> None:
    """Three kinds of files: as they are, in another order and with a further column, and without the value."""
    kind = F.col("event_id").cast("bigint") % 3
    orders = [
        EVENT_COLUMNS,
        ["value", "event_type", "event_id", "note", "ts", "user_id"],
        ["user_id", "ts", "event_id", "event_type"],
    ]
    noted = rows.withColumn("note", F.concat(F.lit("note, of\n"), "event_id"))
    for k, columns in enumerate(orders):
        some = noted.where(kind == k).select(*columns)
        some.write.mode("append").option("header", True).csv(folder)


HEADERS_SQL = f"""
    select * replace (case when event_id::bigint % 3 <> 2 then value end as value),
           case when event_id::bigint % 3 = 1 then 'note, of' || chr(10) || event_id end as note
    from ({EVENTS_SQL})"""


@query("csv_by_header", HEADERS_SQL)
def csv_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose headers differ, one column of which holds line breaks, matched by name."""
    folder = _folder(spark, "headers")
    _by_header(_events(spark, sf), folder)
    return files.sound(files.read_checked(spark, folder, files.CSV, EVENT_COLUMNS))


BAD_LINE_SQL = f"""
    with e as (select *, event_id::bigint % 7 as k from ({EVENTS_SQL}))
    select 'csv' as source, case when k = 1 then 'not 5 fields' when k = 2 then 'not 5 fields' end as reason,
           case when k = 1 then concat_ws(',', event_id, ts, user_id, event_type, value, 'more')
                when k = 2 then concat_ws(',', event_id, ts, user_id) end as record,
           case when k not in (1, 2) then event_id end as event_id, case when k not in (1, 2) then value end as value
    from e
    union all
    select 'json', case when k = 3 then 'not a JSON object' end,
           case when k = 3 then '{{"event_id":"' || event_id || '","value":' end,
           case when k <> 3 then event_id end, case when k <> 3 then value end
    from e"""


@query("bad_records", BAD_LINE_SQL)
def bad_records_query(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with further, missing and broken fields: each comes back once, sound or with its reason."""
    rows = _events(spark, sf)
    kind = F.col("event_id").cast("bigint") % 7
    fields = F.concat_ws(",", *EVENT_COLUMNS)
    longer, shorter = F.concat(fields, F.lit(",more")), F.concat_ws(",", *EVENT_COLUMNS[:3])
    line = F.when(kind == 1, longer).when(kind == 2, shorter).otherwise(fields)
    folder = _folder(spark, "lines")
    # Whole lines in one column, whose name is the header.
    plain = {"header": True, "quote": "", "sep": "\x01"}
    rows.select(line.alias(",".join(EVENT_COLUMNS))).write.options(**plain).csv(f"{folder}/csv")
    cut = F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","value":'))
    rows.select(F.when(kind == 3, cut).otherwise(F.to_json(F.struct(*EVENT_COLUMNS)))).write.text(f"{folder}/json")
    found = []
    for source, columns in ((files.CSV, None), (files.JSON, EVENT_COLUMNS)):
        checked = files.read_checked(spark, f"{folder}/{source}", source, columns)
        named = checked.withColumnsRenamed({files.BAD_REASON: "reason", files.BAD_RECORD: "record"})
        found.append(named.select(F.lit(source).alias("source"), "reason", "record", "event_id", "value"))
    return found[0].unionByName(found[1])


@query(
    "lossless_landing",
    """select doc_id::varchar as id, lang as a, source as b, md5(text) as digest from documents
       union all select conv_id::varchar || ':' || turn::varchar, role, null, md5(text) from conversations
       union all select page_id::varchar, url, '', md5(html) from pages""",
)
def lossless_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The texts of the given tables, landed as CSV and read back."""
    turn = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    documents, turns, pages = (
        table(spark, sf, name).select(key.alias("id"), a.alias("a"), b.alias("b"), F.col(text).alias("text"))
        for name, key, a, b, text in [
            ("documents", F.col("doc_id").cast("string"), F.col("lang"), F.col("source"), "text"),
            ("conversations", turn, F.col("role"), F.lit(None).cast("string"), "text"),
            ("pages", F.col("page_id").cast("string"), F.col("url"), F.lit(""), "html"),
        ]
    )
    lake = Lake(spark, _folder(spark, "landing"))
    rows = documents.unionByName(turns).unionByName(pages)
    lake.write(rows, "landing", "texts", run_at(date(2024, 2, 1), "b"), table_format=files.CSV)
    return lake.read("landing", "texts").select("id", "a", "b", F.md5("text").alias("digest"))


MIDDLE = datetime(2024, 1, 15)


def _event_lake(spark: SparkSession, load_type: str) -> tuple[Lake, TableConfig]:
    """A lake of one table, the events, whose mark is their time."""
    config = replace(
        Metadata().table("orders"),
        table_name="events",
        source_name="events",
        load_type=load_type,
        primary_key="event_id",
        business_key="event_id",
        watermark_column="ts",
        gold_object=None,
    )
    kinds = [DatatypeConfig("events", "ts", "TIMESTAMP")]
    metadata = Metadata(tables=[config], datatypes=kinds, rules=[], gold=[], scd=[])
    return Lake(spark, _folder(spark, "lake"), metadata), config


LAND_SQL = f"""
    with e as ({EVENTS_SQL}), early as (select * from e where ts::timestamp < timestamp '{MIDDLE}'),
    mark as (select max(ts::timestamp) as m from early)
    select 'FULL' as load_type, 'b1' as batch, * from early
    union all select 'FULL', 'b2', * from e
    union all select 'INCREMENTAL', 'b1', * from early
    union all select 'INCREMENTAL', 'b2', e.* from e, mark where ts::timestamp >= m"""


@query("land_modes", LAND_SQL)
def land_modes(spark: SparkSession, sf: str) -> DataFrame:
    """What two runs land of a source that grows between them, by load type."""
    events = _events(spark, sf)
    found = None
    for load_type in (FULL, INCREMENTAL):
        lake, config = _event_lake(spark, load_type)
        sources = Sources(_folder(spark, "sources"))
        early = F.col("ts") < str(MIDDLE)
        for batch, rows in (("b1", events.where(early)), ("b2", events.where(~early))):
            rows.write.mode("append").option("header", True).csv(f"{sources.folder}/events")
            run = run_at(date(2024, 3, 1), batch)
            land(lake, config, sources, run)
            load_bronze(lake, config, run)
            load_silver(lake, config, run)
            landed = landed_rows(lake, "events").select(
                F.lit(load_type).alias("load_type"), F.lit(batch).alias("batch"), *EVENT_COLUMNS
            )
            found = landed if found is None else found.unionByName(landed)
    return found


@query(
    "stream_load",
    f"""select *, 'valid' as outcome from ({HEADERS_SQL})""",
)
def stream_load(spark: SparkSession, sf: str) -> DataFrame:
    """Files with differing headers, taken by a stream through bronze and silver in two starts."""
    lake, config = _event_lake(spark, INCREMENTAL)
    columns = [*EVENT_COLUMNS, "note"]
    folder, checkpoint = _folder(spark, "arriving"), _folder(spark, "progress")
    events = _events(spark, sf)
    half = F.col("event_id").cast("bigint") % 2 == 0
    for rows in (events.where(half), events.where(~half)):
        _by_header(rows, folder)
        run = run_at(date(2024, 3, 1), "unused")
        ingest_files(lake, config, folder, columns, run, checkpoint, files_per_trigger=100).awaitTermination()
    rows = lake.read_batches(SILVER, "events")
    return rows.withColumn("ts", _text("ts")).select(*columns, F.col(OUTCOME).alias("outcome"))
