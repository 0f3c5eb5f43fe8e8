"""Bronze-layer queries: strings, names, types, stamps and hashes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions import columns as cols
from layerloom.operators.evolution import evolve_union, widened
from layerloom.plans.ingest import to_bronze
from layerloom.queries.registry import query, run_at, table

RUN = run_at(date(2024, 2, 1), "batch-1")
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def _with_money(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("decimal(18,2)"))


@query(
    "bronze_customer",
    """
    with b as (
      select cast(c_custkey as varchar) as c_custkey, c_name,
             cast(c_nationkey as varchar) as c_nationkey,
             cast(cast(c_acctbal as decimal(18,2)) as varchar) as c_acctbal, c_mktsegment
      from customer)
    select *, 'batch-1' as _BatchId, 'MANUAL_RUN' as _AdfPipelineRunId,
           date '2024-02-01' as _IngestionTimestamp,
           sha256(concat_ws('||', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment))
             as _RecordHash
    from b""",
)
def bronze_customer(spark: SparkSession, sf: str) -> DataFrame:
    hashed = to_bronze(_with_money(table(spark, sf, "customer"), "c_acctbal"), RUN)
    return hashed.withColumn("_IngestionTimestamp", F.to_date("_IngestionTimestamp"))


@query(
    "record_hash",
    """
    select 'customer' as source, c_custkey as id,
           sha256(concat_ws('||', c_custkey::varchar, c_name, c_nationkey::varchar,
                            c_acctbal::decimal(18,2)::varchar, c_mktsegment)) as hash
    from customer
    union all
    select 'part', p_partkey,
           sha256(concat_ws('||', p_partkey::varchar, p_name, p_brand, p_type, p_size::varchar,
                            p_retailprice::decimal(18,2)::varchar))
    from part
    union all
    select 'document', d.doc_id,
           sha256(concat_ws('||', d.doc_id::varchar, d.text, d.lang, d.source,
                            coalesce(l.quality::varchar, ''), coalesce(l.toxic::varchar, '')))
    from documents d left join labels l on d.doc_id = l.doc_id""",
)
def record_hash(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    sources = {
        "customer": (table(spark, sf, "customer"), CUSTOMER_COLUMNS),
        "part": (table(spark, sf, "part"), PART_COLUMNS),
        "document": (documents, ["doc_id", "text", "lang", "source", "quality", "toxic"]),
    }
    result = None
    for name, (df, columns) in sources.items():
        hashed = df.select(
            F.lit(name).alias("source"),
            F.col(columns[0]).alias("id"),
            cols.record_hash(df, columns, float_type="decimal(18,2)").alias("hash"),
        )
        result = hashed if result is None else result.unionByName(hashed)
    return result


@query(
    "sanitize_columns",
    """select p_partkey as part_key, p_name as p_name_, p_brand as p_brand, p_type as p_type_1_,
              p_size as _size, p_retailprice as retail_price___ from part""",
)
def sanitize_columns(spark: SparkSession, sf: str) -> DataFrame:
    odd = ["part key", "p.name!", "p-brand", "p/type(1)", "%size", "retail price €$"]
    return cols.sanitize_columns(table(spark, sf, "part").select(*PART_COLUMNS).toDF(*odd))


@query(
    "typed_cast",
    """
    select event_id, try_cast(k as integer) as k, try_cast(amount as decimal(18,2))::double as amount,
           try_cast(happened as date) as happened, try_cast(event_type as integer) as event_type,
           props
    from (select event_id, replace(replace(props, '{"k": ', ''), '}', '') as k,
                 (value::decimal(18,4))::varchar as amount, strftime(ts, '%Y-%m-%d') as happened,
                 event_type, props from events)""",
)
def typed_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Strings to declared types; text that does not parse becomes NULL."""
    raw = table(spark, sf, "events").select(
        "event_id",
        F.replace(F.replace("props", F.lit('{"k": ')), F.lit("}")).alias("k"),
        F.col("value").cast("decimal(18,4)").cast("string").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd").alias("happened"),
        "event_type",
        "props",
    )
    declared = {
        "k": "INT",
        "amount": "DECIMAL(18,2)",
        "happened": "DATE",
        "event_type": "INT",
        "not_there": "INT",
    }
    result = cols.typed(raw, declared)
    return result.withColumn("amount", F.col("amount").cast("double"))


@query(
    "conditional_update",
    """select c_custkey, case when c_custkey = 101 then 'Chennai' else c_name end as c_name,
              c_nationkey, c_acctbal,
              case when c_custkey = 101 then 'customer101_new' else c_mktsegment end as c_mktsegment
       from customer""",
)
def conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns of one customer get new values."""
    return cols.update_where(
        table(spark, sf, "customer"),
        F.col("c_custkey") == 101,
        {"c_name": "Chennai", "c_mktsegment": "customer101_new"},
    )


@query(
    "schema_evolution_union",
    """select *, null::varchar as region from customer
       union all by name
       select c_custkey, c_name, c_mktsegment, r_name as region
       from customer join nation on c_nationkey = n_nationkey
                     join region on n_regionkey = r_regionkey""",
)
def schema_evolution_union(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that gains the region and loses two columns."""
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    old = table(spark, sf, "customer")
    new = old.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_mktsegment", F.col("r_name").alias("region")
    )
    return evolve_union(old, new)


@query(
    "schema_evolution_retyped",
    """select o_orderkey::varchar as id, o_totalprice::decimal(18,2)::varchar as amount from orders
       union all
       select c_name, c_acctbal::decimal(18,2)::varchar from customer
       union all
       select p_partkey::varchar, p_size::varchar from part""",
)
def schema_evolution_retyped(spark: SparkSession, sf: str) -> DataFrame:
    """Batches in which a key became text and an amount a whole number."""
    money = lambda c: F.col(c).cast("decimal(18,2)").alias("amount")
    batches = [
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), money("o_totalprice")),
        table(spark, sf, "customer").select(F.col("c_name").alias("id"), money("c_acctbal")),
        table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("amount")),
    ]
    return widened(batches)
