"""Where intermediate results are kept so that later jobs do not redo earlier work."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors reach, as named by the session.

    A cluster must name one. In local mode, without the setting, it is a folder of the warehouse.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
    return f"{spark.conf.get(WAREHOUSE_SETTING).rstrip('/')}/_staged"


def staged(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The result has no lineage to recompute when executors are lost, its columns
    can be pruned by each consumer, and its size is known to the optimizer.
    ``compression`` overrides the session's Parquet codec.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
