"""Run every query on larger, skewed tables and compare with its SQL.

Not collected by pytest: ``python -m tests.check_skew [factor] [query ...]``.
Tables are the sf0.1 ones, repeated ``factor`` times under new keys, with a third
of the order rows under one order, a third of the orders under one customer and
a third of the events under one user. Broadcasts are off and small partitions
are kept apart, so that the plans used are those for large tables.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__  # noqa: F401  registers the queries
from layerloom.queries.registry import ORACLES, QUERIES
from tests.oracle import TABLES, connect

SOURCE = "/root/testdata/sf0.1"

# Key columns to shift per copy, and the column whose values a third of rows share.
KEYS = {
    "customer": ["c_custkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey"],
    "events": ["event_id", "user_id"],
}
HOT = {"orders": "o_custkey", "lineitem": "l_orderkey", "events": "user_id"}
OTHER = {"orders": "o_orderkey", "lineitem": "l_orderkey + l_partkey", "events": "event_id"}


def build(folder: str, factor: int, origin: str = SOURCE) -> None:
    con = duckdb.connect()
    for name in TABLES:
        source = f"read_parquet('{origin}/{name}.parquet')"
        changes = []
        if name in KEYS:
            shifts = {k: f"{k} + copy * 100000000" for k in KEYS[name]}
            if name in HOT:
                hot = HOT[name]
                third = f"hash({OTHER[name]} + copy) % 3 = 0"
                shifts[hot] = f"case when {third} then 7 else {shifts[hot]} end"
            changes = [f"{expr} as {k}" for k, expr in shifts.items()]
            replace = f"replace ({', '.join(changes)})"
            query = f"select * exclude (copy) {replace} from {source}, range({factor}) t(copy)"
        else:
            query = f"select * from {source}"
        con.execute(
            f"copy ({query}) to '{folder}/{name}.parquet' (format parquet, row_group_size 100000)"
        )


def difference(con, result: str, sql: str) -> tuple[int, int, int]:
    con.execute(f"create or replace temp table expected as {sql}")
    columns = ", ".join(sorted(d[0] for d in con.execute("select * from expected limit 0").description))
    ours = f"(select {columns} from read_parquet('{result}/*.parquet'))"
    theirs = f"(select {columns} from expected)"
    n = con.execute("select count(*) from expected").fetchall()[0][0]
    extra = con.execute(f"select count(*) from ({ours} except all {theirs})").fetchall()[0][0]
    lost = con.execute(f"select count(*) from ({theirs} except all {ours})").fetchall()[0][0]
    return n, extra, lost


def main() -> None:
    factor = int(sys.argv[1]) if len(sys.argv) > 1 else 5
    names = sys.argv[2:] or sorted(QUERIES)
    base = tempfile.mkdtemp(prefix="run-")
    tables, results = f"{base}/sf", f"{base}/out"
    os.makedirs(tables)
    build(tables, factor)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("layerloom-skew")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "24")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4MB")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
        .config("spark.sql.files.maxPartitionBytes", "8MB")
        .config("spark.checkpoint.dir", f"{base}/shared")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(tables)
    failures = 0
    for name in names:
        out = f"{results}/{name}"
        start = time.perf_counter()
        df = QUERIES[name](spark, tables)
        df.write.parquet(out)
        took = time.perf_counter() - start
        n, extra, lost = difference(con, out, ORACLES[name])
        failures += bool(extra or lost)
        verdict = "ok" if not (extra or lost) else "DIFFERENT"
        print(f"{name:28} {took:7.2f}s rows={n} extra={extra} lost={lost} {verdict}", flush=True)
    spark.stop()
    sys.exit(bool(failures))


if __name__ == "__main__":
    main()
