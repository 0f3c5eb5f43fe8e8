"""Dimension queries: keys, exchange rates, versions and upserts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators import scd
from layerloom.operators.keys import dense_key, distinct_keys
from layerloom.queries import inputs
from layerloom.queries.inputs import FIRST_LOAD, SECOND_LOAD, THIRD_LOAD, customers_sql
from layerloom.queries.registry import query, run_at, table
from layerloom.sources.rates import json_map
from layerloom.storage import staged

KEY = "CustomerID"
FIRST, SECOND, THIRD = (
    run_at(d, f"batch-{i}") for i, d in enumerate([FIRST_LOAD, SECOND_LOAD, THIRD_LOAD], 1)
)


@query(
    "product_dim",
    """select p_partkey as ProductID, p_name as ProductName, p_type as Category, p_brand as Brand,
              p_retailprice as SellingPrice, row_number() over (order by p_partkey) as ProductSK
       from part""",
)
def product_dim(spark: SparkSession, sf: str) -> DataFrame:
    dim = dense_key(inputs.products(spark, sf), ["ProductID"], "ProductSK", key_type="bigint")
    return dim.withColumn("SellingPrice", F.col("SellingPrice").cast("double"))


@query(
    "fx_dim",
    f"""select BaseCurrency, TargetCurrency, cast(ExchangeRate as double) as ExchangeRate, RateDate,
               row_number() over (order by TargetCurrency) as ExchangeRateSK
        from ({inputs.RATES_SQL})""",
)
def fx_dim(spark: SparkSession, sf: str) -> DataFrame:
    dim = dense_key(inputs.rates(spark, sf), ["TargetCurrency"], "ExchangeRateSK", key_type="bigint")
    return dim.withColumn("ExchangeRate", F.col("ExchangeRate").cast("double"))


@query(
    "fx_unpivot",
    """select event_id, event_type as BaseCurrency, j.key as TargetCurrency,
              cast(j.value as double) as ExchangeRate, cast(ts as date) as RateDate
       from events, json_each(props) j""",
)
def fx_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    answers = table(spark, sf, "events")
    return answers.select(
        "event_id",
        F.col("event_type").alias("BaseCurrency"),
        F.explode(json_map(F.col("props"))).alias("TargetCurrency", "ExchangeRate"),
        F.to_date("ts").alias("RateDate"),
    )


def _source(spark: SparkSession, sf: str, day: date, hashed: list[str] | None = None) -> DataFrame:
    return inputs.customers_as_of(spark, sf, day, hashed)


def _batch(spark: SparkSession, sf: str, day: date, hashed: list[str] | None = None) -> DataFrame:
    """A snapshot as a merge gets it: a written table, read once for the hashes
    and once for the rows."""
    return staged(_source(spark, sf, day, hashed), "batch")


def _first_versions(spark: SparkSession, sf: str, hashed: list[str] | None = None) -> DataFrame:
    return scd.initial_versions(_source(spark, sf, FIRST_LOAD, hashed), KEY, FIRST)


def customer_history(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension after three loads. As between real loads, the result of
    the second is written before the third reads it."""
    dim = _first_versions(spark, sf)
    dim = staged(scd.merge_versions(dim, _batch(spark, sf, SECOND_LOAD), KEY, SECOND), "customers")
    return scd.merge_versions(dim, _batch(spark, sf, THIRD_LOAD), KEY, THIRD)


def _plain(df: DataFrame) -> DataFrame:
    typed = {
        "Balance": "double",
        "_StartDate": "date",
        "_EndDate": "date",
        "CustomerSK": "bigint",
    }
    return df.withColumns({c: F.col(c).cast(t) for c, t in typed.items() if c in df.columns})


BUSINESS_SQL = """CustomerID, CustomerName, City, State, Country,
    cast(Balance as double) as Balance, Priority, LastUpdated, _RecordHash"""
VERSION_SQL = f"{BUSINESS_SQL}, _StartDate, _EndDate, _IsCurrent, CustomerSK"


def _initial_sql(hashed: list[str] | None = None) -> str:
    return f"""select *, date '{FIRST_LOAD}' as _StartDate, cast(null as date) as _EndDate,
                      true as _IsCurrent, row_number() over (order by CustomerID) as CustomerSK
               from ({customers_sql(FIRST_LOAD, hashed)})"""


def _merge_sql(before: str, day: date, hashed: list[str] | None = None) -> str:
    """SQL for one more load on top of the versions given by ``before``."""
    return f"""
    (with d as ({before}), s as ({customers_sql(day, hashed)}),
    opened as (
      select s.* from s left join (select * from d where _IsCurrent) c using (CustomerID)
      where c.CustomerID is null or c._RecordHash <> s._RecordHash)
    select d.* replace (
             case when d._IsCurrent and d._RecordHash <> s._RecordHash
                  then date '{day}' else d._EndDate end as _EndDate,
             d._IsCurrent and not coalesce(d._RecordHash <> s._RecordHash, false)
               as _IsCurrent)
    from d left join s using (CustomerID)
    union all by name
    select opened.*, date '{day}' as _StartDate, cast(null as date) as _EndDate,
           true as _IsCurrent,
           (select max(CustomerSK) from d) + row_number() over (order by CustomerID) as CustomerSK
    from opened)"""


MERGED_SQL = _merge_sql(_initial_sql(), SECOND_LOAD)
HISTORY_SQL = _merge_sql(f"select * from {MERGED_SQL}", THIRD_LOAD)
CUSTOMER_HISTORY_SQL = f"select * from {HISTORY_SQL}"


@query("scd2_initial", f"select {VERSION_SQL} from ({_initial_sql()})")
def scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_first_versions(spark, sf))


@query(
    "scd2_new",
    f"""select {BUSINESS_SQL} from ({customers_sql(SECOND_LOAD)})
        where CustomerID not in (select CustomerID from ({customers_sql(FIRST_LOAD)}))""",
)
def scd2_new(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(
        scd.new_rows(_first_versions(spark, sf), _source(spark, sf, SECOND_LOAD), KEY, SECOND)
    )


CHANGED_SQL = f"""
    select s.* from ({customers_sql(SECOND_LOAD)}) s
    join ({customers_sql(FIRST_LOAD)}) t using (CustomerID) where s._RecordHash <> t._RecordHash"""


@query("scd2_changed", f"select {BUSINESS_SQL} from ({CHANGED_SQL})")
def scd2_changed(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(
        scd.changed_rows(_first_versions(spark, sf), _source(spark, sf, SECOND_LOAD), KEY, SECOND)
    )


@query(
    "scd2_latest",
    f"""select {BUSINESS_SQL}, date '{SECOND_LOAD}' as _StartDate, cast(null as date) as _EndDate,
               true as _IsCurrent
        from (select s.* from ({customers_sql(SECOND_LOAD)}) s
              left join ({customers_sql(FIRST_LOAD)}) t using (CustomerID)
              where t.CustomerID is null or s._RecordHash <> t._RecordHash)""",
)
def scd2_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(
        scd.latest_versions(
            _first_versions(spark, sf), _source(spark, sf, SECOND_LOAD), KEY, SECOND
        )
    )


@query("scd2_merge", f"select {VERSION_SQL} from {MERGED_SQL}")
def scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    dim = _first_versions(spark, sf)
    return _plain(scd.merge_versions(dim, _batch(spark, sf, SECOND_LOAD), KEY, SECOND))


@query("scd2_history", f"select {VERSION_SQL} from {HISTORY_SQL}")
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads; rows closed by the second keep their end date in the third."""
    return _plain(customer_history(spark, sf))


@query("scd2_current", f"select {VERSION_SQL} from {MERGED_SQL} where _IsCurrent")
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    dim = _first_versions(spark, sf)
    merged = scd.merge_versions(dim, _batch(spark, sf, SECOND_LOAD), KEY, SECOND)
    return _plain(scd.current_rows(merged, SECOND))


@query(
    "scd2_tracked",
    f"select {VERSION_SQL} from {_merge_sql(_initial_sql(inputs.TRACKED), SECOND_LOAD, inputs.TRACKED)}",
)
def scd2_tracked(spark: SparkSession, sf: str) -> DataFrame:
    """Only a change of the tracked columns opens a new version."""
    dim = _first_versions(spark, sf, inputs.TRACKED)
    source = _batch(spark, sf, SECOND_LOAD, inputs.TRACKED)
    return _plain(scd.merge_versions(dim, source, KEY, SECOND))


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that ordered since the first load: those who did not are missing."""
    return _batch(spark, sf, SECOND_LOAD).where(F.col("LastUpdated") > F.lit(FIRST_LOAD))


@query(
    "scd2_close_missing",
    f"""with d as ({_initial_sql()}),
    s as (select * from ({customers_sql(SECOND_LOAD)}) where LastUpdated > date '{FIRST_LOAD}'),
    opened as (select s.* from s left join d using (CustomerID)
               where d.CustomerID is null or d._RecordHash <> s._RecordHash)
    select {VERSION_SQL} from (
      select d.* replace (
               case when s._RecordHash = d._RecordHash then null else date '{SECOND_LOAD}' end
                 as _EndDate,
               coalesce(s._RecordHash = d._RecordHash, false) as _IsCurrent)
      from d left join s using (CustomerID)
      union all by name
      select opened.*, date '{SECOND_LOAD}' as _StartDate, cast(null as date) as _EndDate,
             true as _IsCurrent,
             (select max(CustomerSK) from d) + row_number() over (order by CustomerID) as CustomerSK
      from opened)""",
)
def scd2_close_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that vanish from the source are closed."""
    dim = _first_versions(spark, sf)
    return _plain(scd.merge_versions(dim, _recent(spark, sf), KEY, SECOND, close_missing=True))


MARK = date(2024, 1, 15)


@query(
    "scd1_upsert",
    """select user_id, event_id, ts, event_type, value
       from (select *, row_number() over (partition by user_id
                                          order by ts desc, event_id desc) as rn from events)
       where rn = 1""",
)
def scd1_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Events before the mark are the target, later ones the batch to merge."""
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    target = events.where(F.col("ts") < F.lit(MARK))
    batch = events.where(F.col("ts") >= F.lit(MARK))
    return scd.upsert(target, batch, ["user_id"], ["ts", "event_id"])


@query("distinct_keys", "select distinct user_id from events")
def distinct_user_keys(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(table(spark, sf, "events"), ["user_id"])
