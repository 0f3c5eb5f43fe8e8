"""Time our plans against the obvious ones, on enlarged and skewed tables.

Not collected by pytest: ``python -m tests.compare [factor]``.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from layerloom.operators.keys import dense_key, keep_latest
from layerloom.operators.validate import mark, with_copies
from layerloom.queries import quality
from tests.check_skew import build


def main() -> None:
    factor = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    base = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{base}/sf")
    build(f"{base}/sf", factor)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("layerloom-compare")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "16MB")
        .config("spark.checkpoint.dir", f"{base}/shared")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    read = lambda name: spark.read.parquet(f"{base}/sf/{name}.parquet")
    lines, events, customers = read("lineitem"), read("events"), read("customer")
    numbered = lines.withColumn("row", F.monotonically_increasing_id())
    keys = ["l_orderkey", "l_linenumber"]

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def key_window():
        w = Window.orderBy("l_orderkey", "row")
        noop(numbered.withColumn("sk", F.row_number().over(w)))

    def key_ours():
        noop(dense_key(numbered, ["l_orderkey", "row"], "sk", key_type="bigint"))

    def latest_window():
        w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
        noop(events.withColumn("n", F.row_number().over(w)).where("n = 1"))

    def latest_ours():
        noop(keep_latest(events, ["user_id"], ["ts", "event_id"]))

    def copies_window():
        noop(lines.withColumn("n", F.count("*").over(Window.partitionBy(*keys))))

    def copies_ours():
        noop(with_copies(lines, keys))

    def split_twice():
        out = tempfile.mkdtemp(dir=base)
        marked = mark(customers, quality.CUSTOMER_RULES, quality.RUN)
        marked.where("not _IsRejected").write.parquet(f"{out}/valid")
        marked.where("_IsRejected").write.parquet(f"{out}/reject")
        customers.count()
        spark.read.parquet(f"{out}/valid").count()
        spark.read.parquet(f"{out}/reject").count()

    def split_ours():
        out = tempfile.mkdtemp(dir=base)
        marked = mark(customers, quality.CUSTOMER_RULES, quality.RUN)
        marked.write.partitionBy("_IsRejected").parquet(f"{out}/both")

    pairs = {
        "number all order rows": (key_window, key_ours),
        "latest row per user, one user a third": (latest_window, latest_ours),
        "count copies, one order a third": (copies_window, copies_ours),
        "split valid and rejected, with counts": (split_twice, split_ours),
    }
    for label, runs in pairs.items():
        times = []
        for run in runs:
            run()
            best = []
            for _ in range(2):
                start = time.perf_counter()
                run()
                best.append(time.perf_counter() - start)
            times.append(min(best))
        print(f"{label:42} plain {times[0]:6.2f}s  ours {times[1]:6.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
