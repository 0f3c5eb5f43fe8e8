"""The gold layer: dimensions, sales fact and summaries, built from metadata."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.context import RunContext
from layerloom.metadata import DIM, FACT, TYPE2, TableConfig
from layerloom.operators import sales, scd
from layerloom.operators.incremental import INCREMENTAL
from layerloom.operators.keys import dense_key, keep_latest
from layerloom.plans.lake import GOLD, AuditRow, Lake, now
from layerloom.plans.silver import key_columns, valid_rows
from layerloom.storage import staged

# Surrogate keys of the dimensions and names of the gold tables.
SURROGATE_KEYS = {
    "customer_dim": "CustomerSK",
    "product_dim": "ProductSK",
    "exchange_rate_dim": "ExchangeRateSK",
}
FACT_TABLE = "fact_sales"
SALES_SUMMARY = "sales_summary"
CUSTOMER_SALES_SUMMARY = "customer_sales_summary"
# Ours: what the summaries add up, and the periods that runs have changed in the fact.
CUSTOMER_DAYS = "customer_days"
TOUCHED = "fact_sales_touched"

# Folder columns of versioned dimensions.
STATE, CURRENT, CLOSED = "_VersionState", "current", "closed"
FOLDER = "_KeyRange"
#: Surrogate keys in one range of a versioned dimension: what a single change rewrites.
RANGE_KEYS = 1_000_000
RANGES = "{}_ranges"
RANGES_SCHEMA = "key_range bigint, batch_id string, range_keys bigint, highest_key bigint, folder_ranges bigint"


def _folder(key_range: Column, folder_ranges: int, batch_id: Column) -> Column:
    """Folders of one range, or of neighbouring ones, differ from batch to batch, so their names say all."""
    return F.concat_ws("-", F.floor(key_range / folder_ranges).cast("string"), batch_id)


def _range_of(surrogate: str, range_keys: int) -> Column:
    return F.expr(f"({surrogate} - 1) div {range_keys}")


def key_ranges(lake: Lake, name: str, batch_id: str) -> DataFrame:
    """The ranges of a versioned dimension after a batch, each with the batch that wrote it last."""
    ranges = lake.read_batch(GOLD, RANGES.format(name), batch_id)
    # Batches written before ranges could share a folder have one for each.
    return ranges if "folder_ranges" in ranges.columns else ranges.withColumn("folder_ranges", F.lit(1).cast("bigint"))


def _layout(ranges: DataFrame) -> tuple[int | None, int | None, int]:
    """Keys in a range, ranges in a folder (None where there are no ranges), and the highest key given so far."""
    found = ranges.agg(F.max("range_keys"), F.max("folder_ranges"), F.max("highest_key")).first()
    return found[0], found[1], found[2] or 0


def current_versions(lake: Lake, name: str, only: Collection[int] | DataFrame | None = None) -> DataFrame:
    """Of each range of keys, or of some, the current rows of the batch that wrote it last. Folders without
    such rows are not read. ``only`` names the ranges, as a frame (``key_range``) where they may be many.

    Names of folders reach the driver: one for each million versions, or for each of the ranges that are larger.
    """
    last = lake.last_commit(GOLD, name)
    if last is None:
        raise LookupError(f"dimension {name} has not been built")
    ranges = key_ranges(lake, name, last.batch_id)
    range_keys, folder_ranges, _ = _layout(ranges)
    if isinstance(only, DataFrame):
        ranges = ranges.join(only, "key_range", "left_semi")
    elif only is not None:
        ranges = ranges.where(F.col("key_range").isin(list(only)))
    ranges = ranges.select(
        "key_range", "batch_id", _folder(F.col("key_range"), folder_ranges or 1, F.col("batch_id")).alias(FOLDER)
    )
    live = ranges.select("batch_id", FOLDER).distinct().collect()
    # The last batch is read for its columns even if it wrote no range.
    commits = lake.commits(GOLD, name, batch_id=[*{r["batch_id"] for r in live}, last.batch_id])
    rows = lake.load(commits).where((F.col(STATE) == CURRENT) & F.col(FOLDER).isin([r[FOLDER] for r in live]))
    if folder_ranges is not None and folder_ranges > 1:
        # A folder may hold ranges that a later batch wrote again.
        wanted = ranges.select(F.col("key_range").alias("__range"), F.col(FOLDER).alias("__folder"))
        here = _range_of(SURROGATE_KEYS[name], range_keys)
        rows = rows.join(wanted, (here == F.col("__range")) & (F.col(FOLDER) == F.col("__folder")), "left_semi")
    return rows.drop(STATE, FOLDER)


def versions(lake: Lake, name: str) -> DataFrame:
    """All versions of a dimension: what each run closed, and the current rows."""
    closed = lake.read_batches(GOLD, name).where(F.col(STATE) == CLOSED).drop(STATE, FOLDER)
    return closed.unionByName(current_versions(lake, name), allowMissingColumns=True)


def gold_table(lake: Lake, name: str) -> DataFrame:
    """A gold table as its readers see it."""
    rows = lake.read(GOLD, name)
    return versions(lake, name) if STATE in rows.columns else rows.drop(sales.PERIOD)


def load_versions(
    lake: Lake,
    config: TableConfig,
    name: str,
    run: RunContext,
    key: str,
    *,
    range_keys: int = RANGE_KEYS,
    folder_ranges: int = 1,
) -> AuditRow | None:
    """Merge the silver batches that came in since the dimension was last
    built. Reading from the start of that build makes a batch committed
    meanwhile count as new; merging a batch twice changes nothing.

    Current rows lie in ranges of surrogate keys. A run finds the changes from
    keys and hashes alone, and writes the ranges in which it closes or opens a
    version, and the rows it closed. All other ranges stay in the folders of
    earlier runs, and so do versions closed earlier. Which run wrote a range
    last, and the highest key given so far, are written down before the rows
    are committed, so readers see the old state or the new one as a whole.

    What a run writes of ``folder_ranges`` neighbouring ranges shares a folder:
    small ranges would otherwise make as many folders, each with a few rows.
    ``range_keys`` and ``folder_ranges`` hold from the first run on.
    """
    began = now()
    surrogate = SURROGATE_KEYS[name]
    last = lake.last_commit(GOLD, name)
    source = valid_rows(lake, config, run, since=last.started_at if last else None)
    if source is not None:
        # Read twice below, and reducing it to the latest rows is a shuffle.
        source = staged(source, f"{name}-batch")
    held, touched, highest = None, None, 0
    if last is None:
        if source is None:
            return None
        rows = scd.initial_versions(source, key, run, surrogate=surrogate)
        opened = rows.count()
    else:
        held = key_ranges(lake, name, last.batch_id)
        keys, in_folder, highest = _layout(held)
        range_keys, folder_ranges = keys or range_keys, in_folder or folder_ranges
        rows, opened = current_versions(lake, name), 0
    range_of = _range_of(surrogate, range_keys)
    if last is not None and source is None:
        rows = rows.limit(0)
    elif last is not None:
        changes = scd.find_changes(rows, source, key, run, surrogate=surrogate)
        opened = changes.where(scd.opening()).count()
        touched = changes.where(scd.closing()).select(range_of.alias("key_range"))
    if opened:
        filled = lake.spark.range(highest // range_keys, (highest + opened - 1) // range_keys + 1).toDF("key_range")
        touched = filled if touched is None else touched.union(filled)
    if touched is not None:
        touched = touched.distinct()
    if last is not None and source is not None:
        # Asked for by the rows, their folders and the ranges below.
        touched = staged(touched, "touched-ranges")
        rows = current_versions(lake, name, only=touched)
        rows = scd.apply_changes(rows, source, changes, key, run, highest=highest, surrogate=surrogate)

    ranges = lake.spark.createDataFrame([], "key_range bigint, batch_id string")
    if touched is not None:
        ranges = touched.withColumn("batch_id", F.lit(run.batch_id))
    if held is not None:
        others = held if touched is None else held.join(touched, "key_range", "left_anti")
        ranges = ranges.unionByName(others.select("key_range", "batch_id"))
    settled = {"range_keys": range_keys, "highest_key": highest + opened, "folder_ranges": folder_ranges}
    ranges = ranges.withColumns({c: F.lit(v).cast("bigint") for c, v in settled.items()})
    lake.write(ranges.hint("rebalance"), GOLD, RANGES.format(name), run, started=began)
    is_current = F.col(run.columns.is_current)
    rows = rows.withColumns(
        {
            STATE: F.when(is_current, CURRENT).otherwise(CLOSED),
            FOLDER: F.when(is_current, _folder(range_of, folder_ranges, F.lit(run.batch_id))),
        }
    )
    return lake.write(
        # The first versions are sorted by key already.
        rows if last is None else rows.hint("rebalance", STATE, FOLDER),
        GOLD,
        name,
        run,
        table_format=config.target_file_format,
        partition_by=[STATE, FOLDER],
        started=began,
    )


def load_dimension(lake: Lake, config: TableConfig, name: str, run: RunContext) -> AuditRow | None:
    """A dimension without history: current rows numbered in key order."""
    rows = valid_rows(lake, config, run)
    if rows is None:
        return None
    keyed = dense_key(rows, key_columns(config.business_key), SURROGATE_KEYS[name])
    return lake.write(keyed, GOLD, name, run, table_format=config.target_file_format)


def _last_run(lake: Lake) -> AuditRow | None:
    """The last run that built all sales tables; the customer summary is the last of them."""
    return lake.last_commit(GOLD, CUSTOMER_SALES_SUMMARY)


def _on(periods: Sequence[date | None]) -> Column:
    """Rows of some periods, as a filter on the folders."""
    found = F.col(sales.PERIOD).isin([d for d in periods if d is not None])
    return found | F.col(sales.PERIOD).isNull() if None in periods else found


def _periods(frame: DataFrame) -> DataFrame:
    return frame.select(sales.PERIOD).distinct()


def _collected(periods: DataFrame) -> list[date | None]:
    """The periods reach the driver: one for each month of the calendar at most."""
    return [r[0] for r in periods.distinct().collect()]


def _rekeyed(lake: Lake, fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Periods with rows whose customer or product has another key now than when they were written.

    Customers are looked up in the table of customers and days. Products are only
    sought in the fact if the dimension itself has changed.
    """
    held = lake.read(GOLD, CUSTOMER_DAYS).select(sales.PERIOD, "CustomerID", "CustomerSK")
    now = customers.select("CustomerID", F.col("CustomerSK").alias("__now"))
    periods = _periods(held.join(now, "CustomerID", "left").where(~F.col("CustomerSK").eqNullSafe(F.col("__now"))))
    before = lake.commits(GOLD, "product_dim", batch_id=_last_run(lake).batch_id)
    keys = products.select("ProductID", "ProductSK")
    if before:
        keys = keys.join(lake.load(before).select("ProductID", "ProductSK"), ["ProductID", "ProductSK"], "left_anti")
        if not keys.head(1):
            return periods
    moved = fact.select(sales.PERIOD, "ProductID").join(keys.select("ProductID"), "ProductID", "left_semi")
    return periods.union(_periods(moved))


def _periods_of_keys(fact: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Periods in which the fact holds rows with the keys of a batch.

    The lowest and highest key go to the scan as filters: where keys grow with
    time, only the files of recent periods are read.
    """
    low, high = batch.agg(F.min(keys[0]), F.max(keys[0])).first()
    near = fact.where(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    return _periods(near.select(sales.PERIOD, *keys).join(batch.select(*keys), keys, "left_semi"))


def load_fact(lake: Lake, config: TableConfig, run: RunContext) -> AuditRow | None:
    """Bring the fact up to date, rewriting only the periods that something happened to.

    Those are the months of the order rows that came in since the last run, those
    in which their earlier versions lie, and those with rows whose customer or
    product has a new key. They are written down first: a run that fails further
    on leaves them to the next one. The result is that of building everything anew.
    Full tables, and the first run, do build everything anew.
    """
    began = now()
    last = _last_run(lake)
    names = run.columns
    audit = [names.batch_id, names.run_id, names.processed_at]
    planned = [] if last is None else lake.commits(GOLD, TOUCHED, batch_id=last.batch_id)
    since = planned[0].started_at if planned and config.load_type == INCREMENTAL else None
    batch = valid_rows(lake, config, run, since=since)
    customers, products = current_versions(lake, "customer_dim"), lake.read(GOLD, "product_dim")
    if since is None:
        if batch is None:
            return None
        everything = lake.spark.createDataFrame([(None, True)], f"{sales.PERIOD} date, everything boolean")
        lake.write(everything, GOLD, TOUCHED, run, started=began)
        fact = sales.with_period(sales.fact_sales(batch, customers, products, audit=audit))
        return lake.write(
            fact, GOLD, FACT_TABLE, run, table_format=config.target_file_format, partition_by=[sales.PERIOD], replace=True
        )

    fact = lake.read(GOLD, FACT_TABLE)
    keys = key_columns(config.primary_key)
    missing = [k for k in keys if k not in fact.columns]
    if missing:
        raise ValueError(f"the fact lacks the key columns {missing} of {config.table_name}")
    own = [c for c in fact.columns if c not in ("CustomerSK", "ProductSK")]
    periods = _rekeyed(lake, fact, customers, products)
    if batch is not None:
        batch = staged(sales.with_period(batch).select(*own), "orders-batch", "zstd")
        periods = periods.union(_periods(batch)).union(_periods_of_keys(fact, batch, keys))
    unfinished = lake.read_batches(GOLD, TOUCHED, since=last.processed_at)
    if unfinished is not None:
        periods = periods.union(_periods(unfinished.where("not everything")))
    periods = staged(periods.distinct(), "touched")
    lake.write(periods.withColumn("everything", F.lit(False)), GOLD, TOUCHED, run, started=began)

    rows = fact.where(_on(_collected(periods))).select(*own)
    if batch is not None:
        # Of the rows with a key of the batch the latest stays, as in a rebuild; the others pass.
        met = rows.join(batch.select(*keys), keys, "left_semi").unionByName(batch)
        order = [config.watermark_column] if config.watermark_column in own else []
        latest = keep_latest(met, keys, [*order, names.processed_at], few=True)
        rows = rows.join(batch.select(*keys), keys, "left_anti").unionByName(latest)
    renewed = sales.fact_sales(rows.drop(sales.PERIOD), customers, products, audit=audit)
    # What replaces a folder must not be read from it meanwhile.
    renewed = staged(sales.with_period(renewed).select(*fact.columns), "fact-periods", "zstd")
    return lake.write(
        renewed,
        GOLD,
        FACT_TABLE,
        run,
        table_format=config.target_file_format,
        partition_by=[sales.PERIOD],
        replace=periods,
    )


def load_summaries(lake: Lake, run: RunContext) -> list[AuditRow]:
    """Both summaries, written unsorted: order is a matter of the reader.

    They add up a table of customers and days, of which only the periods are
    replaced that the fact has touched since the last run; the daily summary
    keeps its days of other periods. The customer summary, written last, ends the run.
    """
    last = _last_run(lake)
    touched = lake.read_batches(GOLD, TOUCHED, since=last.processed_at if last else None)
    if touched is None:
        return []
    fact = lake.read(GOLD, FACT_TABLE)
    customers = current_versions(lake, "customer_dim")
    everything = last is None or bool(touched.where("everything").head(1))
    periods = _periods(touched)
    if not everything:
        chosen = _on(_collected(periods))
        fact = fact.where(chosen)
    by_customer = lake.write(
        sales.customer_days(fact), GOLD, CUSTOMER_DAYS, run, partition_by=[sales.PERIOD], replace=everything or periods
    )
    held = lake.read(GOLD, CUSTOMER_DAYS)
    if everything:
        daily = sales.sales_summary_of_days(held)
    else:
        before = lake.read(GOLD, SALES_SUMMARY)
        others = sales.with_period(before).where(~F.coalesce(chosen, F.lit(False))).drop(sales.PERIOD)
        daily = others.unionByName(sales.sales_summary_of_days(held.where(chosen)))
    return [
        by_customer,
        lake.write(daily, GOLD, SALES_SUMMARY, run),
        lake.write(sales.customer_sales_summary_of_days(held, customers), GOLD, CUSTOMER_SALES_SUMMARY, run),
    ]


def load_gold(lake: Lake, run: RunContext) -> list[AuditRow]:
    """Dimensions first, then facts and summaries, as the metadata lists them.

    A table whose ``gold_object`` is a dimension but which has no row of its
    own in the gold configuration (the exchange rates) is built as one too.
    """
    versioned = {s.table_name: s for s in lake.metadata.scd if s.scd_type == TYPE2}
    listed = {g.gold_object: (g.source_table, g.object_type) for g in lake.metadata.gold}
    for config in lake.metadata.active_tables():
        if config.gold_object:
            listed.setdefault(config.gold_object, (config.table_name, DIM))
    active = {c.table_name: c for c in lake.metadata.active_tables()}

    done: list[AuditRow | None] = []
    for kind in (DIM, FACT):
        for name, (source, object_type) in listed.items():
            if object_type != kind or source not in active:
                continue
            config = active[source]
            if kind == FACT:
                done.append(load_fact(lake, config, run))
            elif source in versioned:
                key = versioned[source].business_key
                done.append(load_versions(lake, config, name, run, key))
            else:
                done.append(load_dimension(lake, config, name, run))
    if lake.exists(GOLD, FACT_TABLE):
        done.extend(load_summaries(lake, run))
    # What the loads wrote down for readers and for the next run is in the audit log as well.
    for name in [*[RANGES.format(d) for d in SURROGATE_KEYS], TOUCHED]:
        done.extend(lake.commits(GOLD, name, batch_id=run.batch_id))
    return [row for row in done if row is not None]
