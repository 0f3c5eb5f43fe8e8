"""Ingest files as they arrive, with Structured Streaming.

Each trigger takes the files that came in since the last one and passes them
through the same bronze and silver steps as a batch load. The query's id, which
its checkpoint keeps, and the epoch name the batch, so an epoch that is replayed
after a failure replaces what it had begun to write, one that is committed
already is left alone, and another query on the same table has other batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from layerloom.context import RunContext
from layerloom.metadata import TableConfig
from layerloom.plans.ingest import to_bronze
from layerloom.plans.lake import BRONZE, SILVER, Lake
from layerloom.plans.silver import load_silver
from layerloom.sources.files import bad, literal_paths, read_checked, sound

#: Layer of the records that a stream could not read: file, reason and record.
REJECTS = "rejects"


def ingest_files(
    lake: Lake,
    config: TableConfig,
    folder: str,
    columns: Sequence[str],
    run: RunContext,
    checkpoint: str,
    *,
    files_per_trigger: int | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None),
) -> StreamingQuery:
    """Process all CSV or JSON files not seen before, then stop. Every epoch is stamped by the clock.

    ``columns`` are taken by name, whatever their order in a file; columns that a
    file lacks are NULL, further ones are left out. Records that cannot be read
    go to the table of the same name in the layer ``REJECTS``.

    ``checkpoint`` must be a folder shared by the cluster and kept between runs.
    """
    # The stream is one of files, not of their rows: each epoch reads its files as a
    # batch does, by the names in their headers. Their contents are not read here.
    listed = "path string, modificationTime timestamp, length bigint, content binary"
    reader = lake.spark.readStream.schema(listed).format("binaryFile")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def load(batch: DataFrame, epoch: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        now = clock()
        step = replace(
            run, batch_id=f"stream-{query_id}-{epoch:012d}", run_ts=now, as_of=now.date()
        )
        name = config.table_name
        paths = [r.path for r in batch.collect()]
        if not lake.is_committed(BRONZE, name, step.batch_id):
            checked = read_checked(lake.spark, literal_paths(paths), config.file_format, columns)
            if not lake.is_committed(REJECTS, name, step.batch_id) and bad(checked).head(1):
                lake.write(bad(checked), REJECTS, name, step)
            raw = sound(checked).select(*[f"`{c}`" for c in columns])
            bronze = to_bronze(raw, step, business=list(columns))
            lake.write(bronze, BRONZE, name, step, table_format=config.target_file_format)
        if not lake.is_committed(SILVER, name, step.batch_id):
            load_silver(lake, config, step, bronze_batch=step.batch_id)

    return (
        reader.load(folder)
        .select("path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
