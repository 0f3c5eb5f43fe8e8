"""Layered tables and their audit log.

Each run writes a table into a fresh folder ``<layer>/<table>/_LoadBatch=<id>``
and then appends one row to the audit log. The row is the commit: readers use
the folder of the last successful one. So a run may read a table and replace it,
a failed run leaves the old contents in place, and counts, schema and high-water
mark become visible together with the data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import astuple, dataclass, fields
from datetime import datetime, timezone
from itertools import pairwise

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.context import RunContext
from layerloom.metadata import SCHEMAS, Metadata
from layerloom.operators.evolution import schema_changes, widened
from layerloom.sources.files import CSV, JSON, LANDED, escaped, unescaped

LANDING, BRONZE, SILVER, GOLD = "landing", "bronze", "silver", "gold"
SUCCESS, FAILED = "SUCCESS", "FAILED"
AUDIT = "audit_log"
BATCH_FOLDER = "_LoadBatch"
# Tables of which runs replace some partitions live in one folder; their audit rows say so.
PARTITIONS_FOLDER, IN_PARTITIONS = "_Partitions", "/partitions"
# False in the row that stands for a replaced partition, so that one without rows is replaced too.
KEPT = "_Kept"


@dataclass(frozen=True)
class AuditRow:
    run_id: str
    batch_id: str
    layer: str
    table_name: str
    started_at: datetime
    processed_at: datetime
    records_read: int | None
    records_written: int | None
    records_rejected: int | None
    status: str
    watermark: datetime | None
    table_format: str
    table_schema: str | None
    error_message: str | None


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField(
            f.name,
            T.LongType()
            if f.name.startswith("records_")
            else T.TimestampNTZType()
            if f.name in ("started_at", "processed_at", "watermark")
            else T.StringType(),
        )
        for f in fields(AuditRow)
    ]
)


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Lake:
    """Tables under one base path, described by one set of metadata."""

    def __init__(self, spark: SparkSession, base: str, metadata: Metadata | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.metadata = metadata or Metadata()

    def path(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"

    # -- audit log ---------------------------------------------------------

    def audit_log(self) -> DataFrame | None:
        """All audit rows, or None before the first one is written."""
        try:
            return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path("metadata", AUDIT))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _successes(self, layer: str, table: str) -> DataFrame | None:
        log = self.audit_log()
        if log is None:
            return None
        return log.where(
            (F.col("layer") == layer) & (F.col("table_name") == table) & (F.col("status") == SUCCESS)
        )

    def commits(
        self,
        layer: str,
        table: str,
        since: datetime | None = None,
        *,
        batch_id: str | Sequence[str] | None = None,
    ) -> list[AuditRow]:
        """Successful writes of one table after a moment, or of one or more batches, oldest first."""
        found = self._successes(layer, table)
        if found is None:
            return []
        if batch_id is not None:
            found = found.where(F.col("batch_id").isin([batch_id] if isinstance(batch_id, str) else list(batch_id)))
        if since is not None:
            found = found.where(F.col("processed_at") > F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
        names = [f.name for f in fields(AuditRow)]
        rows = [AuditRow(*r) for r in found.select(*names).collect()]
        return sorted(rows, key=lambda r: r.processed_at)

    def last_commit(self, layer: str, table: str) -> AuditRow | None:
        """One row reaches the driver, however many runs there were."""
        found = self._successes(layer, table)
        if found is None:
            return None
        names = [f.name for f in fields(AuditRow)]
        row = found.agg(F.max_by(F.struct(*names), "processed_at").alias("last")).first()["last"]
        return None if row is None else AuditRow(*row)

    def is_committed(self, layer: str, table: str, batch_id: str) -> bool:
        found = self._successes(layer, table)
        return found is not None and bool(found.where(F.col("batch_id") == batch_id).head(1))

    def last_mark(self, layer: str, table: str) -> datetime | None:
        """Highest mark committed so far, or the configured first one."""
        found = self._successes(layer, table)
        mark = None if found is None else found.agg(F.max("watermark")).first()[0]
        return mark or self.metadata.first_mark(table)

    def _append_audit(self, row: AuditRow) -> None:
        frame = self.spark.createDataFrame([astuple(row)], AUDIT_SCHEMA).coalesce(1)
        path = self.path("metadata", AUDIT)
        frame.write.mode("append").partitionBy("layer", "table_name").parquet(path)

    def schema_history(self, layer: str, table: str) -> list[tuple[str, list[tuple]]]:
        """(batch, changes against the batch before) where a schema changed."""
        schemas = [
            (c.batch_id, T.StructType.fromJson(json.loads(c.table_schema)))
            for c in self.commits(layer, table)
        ]
        changed = [
            (batch, schema_changes(old, new)) for (_, old), (batch, new) in pairwise(schemas)
        ]
        return [(batch, changes) for batch, changes in changed if changes]

    # -- tables ------------------------------------------------------------

    def exists(self, layer: str, table: str) -> bool:
        return self.last_commit(layer, table) is not None

    def load(self, commits: Sequence[AuditRow]) -> DataFrame:
        """The rows of some batches: one scan for all that share a schema."""
        batches: dict[tuple[str, str, str], list[str]] = {}
        for c in commits:
            folder = self.path(c.layer, c.table_name)
            batch = f"{folder}/{BATCH_FOLDER}={c.batch_id}"
            if c.table_format.endswith(IN_PARTITIONS):
                folder = batch = f"{folder}/{PARTITIONS_FOLDER}"
            paths = batches.setdefault((folder, c.table_format, c.table_schema), [])
            if batch not in paths:
                paths.append(batch)
        frames = []
        for (folder, table_format, text), paths in batches.items():
            schema = T.StructType.fromJson(json.loads(text))
            if table_format in (CSV, JSON):
                # Text is read as it was written: every value a string.
                schema = T.StructType([T.StructField(n, T.StringType()) for n in schema.names])
            in_partitions = table_format.endswith(IN_PARTITIONS)
            table_format = table_format.removesuffix(IN_PARTITIONS)
            reader = self.spark.read.format(table_format).schema(schema).option("basePath", folder)
            if table_format == CSV:
                reader = reader.options(**LANDED)
            rows = reader.load(paths).drop(BATCH_FOLDER)
            if table_format == CSV:
                rows = rows.select(*[unescaped(F.col(f"`{c}`")).alias(c) for c in rows.columns])
            frames.append(rows.where(KEPT).drop(KEPT) if in_partitions else rows)
        return widened(frames)

    def read(self, layer: str, table: str) -> DataFrame:
        """The table as of its last successful write."""
        commit = self.last_commit(layer, table)
        if commit is None:
            raise LookupError(f"table {layer}/{table} has not been written")
        return self.load([commit])

    def read_batch(self, layer: str, table: str, batch_id: str) -> DataFrame:
        """The rows of one committed batch."""
        found = self.commits(layer, table, batch_id=batch_id)
        if not found:
            raise LookupError(f"batch {batch_id} of {layer}/{table} has not been written")
        return self.load(found)

    def read_or_none(self, layer: str, table: str) -> DataFrame | None:
        return self.read(layer, table) if self.exists(layer, table) else None

    def read_batches(
        self, layer: str, table: str, since: datetime | None = None
    ) -> DataFrame | None:
        """Rows of every batch, or of those committed after a moment."""
        commits = self.commits(layer, table, since)
        return self.load(commits) if commits else None

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        run: RunContext,
        *,
        table_format: str = "parquet",
        options: Mapping[str, object] | None = None,
        partition_by: Sequence[str] = (),
        rejected: Column | None = None,
        watermark: Column | None = None,
        replace: DataFrame | bool | None = None,
        started: datetime | None = None,
    ) -> AuditRow:
        """Write one batch and commit it. Counts and mark are taken while the
        rows are written, so the table is never read again to count it.

        With ``replace`` the table is kept by partition: the batch takes the
        place of the partitions that ``replace`` names (a frame of the partition
        columns, which must hold those of all rows), or of all if it is True.
        Other partitions are not touched. Spark swaps partitions in one after
        the other, so a run that fails there has to be repeated.
        """
        if self.is_committed(layer, table, run.batch_id):
            raise ValueError(f"batch {run.batch_id} of {layer}/{table} is committed already")
        started = started or now()
        target = f"{self.path(layer, table)}/{BATCH_FOLDER}={run.batch_id}"
        named_format, counted = table_format, F.lit(True)
        if replace is not None:
            target = f"{self.path(layer, table)}/{PARTITIONS_FOLDER}"
            named_format, counted = table_format + IN_PARTITIONS, F.col(KEPT)
            # Files of fair size, whatever the partitions hold.
            df = df.withColumn(KEPT, F.lit(True)).hint("rebalance", *partition_by)
            if replace is not True:
                stands = replace.select(*partition_by).distinct().withColumn(KEPT, F.lit(False))
                df = df.unionByName(stands, allowMissingColumns=True)
            mode = "static" if replace is True else "dynamic"
            options = {"partitionOverwriteMode": mode} | dict(options or {})
        observed = Observation()
        metrics = [
            F.count_if(counted).alias("total"),
            F.count_if(F.lit(False) if rejected is None else rejected).alias("bad"),
            F.max(F.lit(None) if watermark is None else watermark)
            .cast("timestamp_ntz")
            .alias("mark"),
        ]

        def row(status: str, counts: Mapping[str, object], error: str | None = None) -> AuditRow:
            total, bad = counts.get("total"), counts.get("bad") or 0
            return AuditRow(
                run.run_id,
                run.batch_id,
                layer,
                table,
                started,
                now(),
                total,
                None if total is None else total - bad,
                None if total is None else bad,
                status,
                counts.get("mark"),
                named_format,
                json.dumps(df.schema.jsonValue()),
                error,
            )

        try:
            rows = df.observe(observed, *metrics)
            if table_format == CSV:
                rows = rows.select(*[escaped(F.col(f"`{c}`")).alias(c) for c in rows.columns])
                options = LANDED | dict(options or {})
            writer = rows.write.mode("overwrite").format(table_format)
            writer = writer.options(**(options or {}))
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.save(target)
        except Exception as error:
            self._append_audit(row(FAILED, {}, str(error)))
            raise
        committed = row(SUCCESS, observed.get)
        self._append_audit(committed)
        return committed

    # -- metadata ----------------------------------------------------------

    def save_metadata(self) -> None:
        for name, df in self.metadata.frames(self.spark).items():
            df.coalesce(1).write.mode("overwrite").parquet(self.path("metadata", name))

    @classmethod
    def open(cls, spark: SparkSession, base: str) -> "Lake":
        """A lake with the metadata stored in it."""
        lake = cls(spark, base)
        frames = {
            name: spark.read.schema(schema).parquet(lake.path("metadata", name))
            for name, schema in SCHEMAS.items()
        }
        lake.metadata = Metadata.from_frames(frames)
        return lake
