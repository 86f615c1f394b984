"""Headline queries over a message archive; prints one JSON line.

The archive and its inverted reference table, which correlations use, are written first from the tables at $BENCH_SF_DIR
and reported apart (``archive_sec``, ``index_sec``): the published baseline scans messages that already exist, too. Every query is run once to warm up and then timed to its last row.
``job_overhead_sec`` is an empty Spark job.
"""

from __future__ import annotations

import json
import os
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import bustrace as b
from bustrace.operators.offsets import watermarks
from bustrace.session import scratch_path
from catalog.bus import PLAIN, committed_offsets, raw_messages, table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FOLLOW = ["shipments", "returns", "activity"]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    work()
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    b.configure(spark)
    start = time.perf_counter()
    path = scratch_path(spark, "bench")
    b.write_archive(raw_messages(spark, SF_DIR, PLAIN), path)
    archive_sec = round(time.perf_counter() - start, 3)
    raw, blocks = b.read_archive(spark, path), b.read_blocks(spark, path)
    start = time.perf_counter()
    index_path = scratch_path(spark, "bench-index")
    b.write_index(raw, index_path)
    index_sec = round(time.perf_counter() - start, 3)
    index = b.read_index(spark, index_path)
    messages = raw.count()
    order = F.col("o_orderkey")
    orders = table(spark, SF_DIR, "orders")
    keys = orders.select(F.format_string("ORD-%d", order).alias("key"))

    def correlate(n: int | None) -> DataFrame:
        wanted = keys if n is None else orders.filter(order < n).select(F.format_string("ORD-%d", order).alias("key"))
        seeds = b.search_many(raw, wanted, topics=["orders"]).drop("search_key")
        return b.correlate(raw, seeds, FOLLOW, limit=None, bidirectional=True, index=index)

    window = {"time_from": datetime(1996, 1, 1), "time_to": datetime(1997, 1, 1)}
    queries = {
        "search_key": lambda: b.search_messages(raw, "USR-7", limit=None),
        "search_key_limit": lambda: b.search_messages(raw, "ORD-7", limit=500),
        "search_header": lambda: b.search_messages(raw, "TR-7", key_field="header:trace-id"),
        "search_value_path": lambda: b.search_messages(raw, "ORD-7", key_field="value:orderId"),
        "search_boolean": lambda: b.search_messages(raw, "True", key_field="value:open", limit=None),
        "search_window": lambda: b.search_messages(
            raw, "SUP-3", key_field="value:shipment.supplier", limit=None, **window
        ),
        "search_many_all_orders": lambda: b.search_many(raw, keys, key_field="value:orderId"),
        "decode_all": lambda: b.decode(b.normalize(raw)).select("topic", "partition", "offset", "value"),
        "evidence_all": lambda: b.enrich(raw).select("topic", "partition", "offset", "keys"),
        "watermarks": lambda: b.watermarks(raw, blocks=blocks),
        "consumer_lag": lambda: b.consumer_group_lag(committed_offsets(raw), watermarks(raw, blocks=blocks)),
        "investigate": lambda: b.investigate(raw, "ORD-7", FOLLOW, initial_topics=["orders"], bidirectional=True, index=index),
        "correlate_1": lambda: correlate(1),
        "correlate_10": lambda: correlate(10),
        "correlate_1000": lambda: correlate(1000),
        "correlate_all_orders": lambda: correlate(None),
    }
    seconds = {name: timed(lambda build=build: run(build())) for name, build in queries.items()}
    per_message = ("search_key", "search_value_path", "search_boolean", "decode_all", "evidence_all")
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "messages": messages,
                "archive_sec": archive_sec,
                "index_sec": index_sec,
                "job_overhead_sec": timed(lambda: run(spark.range(1))),
                "ns_per_message": {q: round(seconds[q] / messages * 1e9) for q in per_message},
            }
        )
    )


if __name__ == "__main__":
    main()
