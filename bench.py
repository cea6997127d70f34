"""Time the headline queries; prints one JSON line.

Each query is run to the end (every row and column is computed), once to warm up and then
BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from sluiceway.catalogue import QUERIES
from sluiceway.sources import storage

HEADLINES = (
    "snapshot",
    "snapshot_then_transform",
    "apply_changes",
    "update_file_table",
    "update_partitioned_table",
    "digest_md5",
    "digest_sha2_512",
    "transform_order",
    "filter_rows",
    "json_roundtrip",
    "json_infer",
    "format_parquet",
    "partitioned_write",
    "topic_append_offsets",
    "flow_batch_snapshot",
    "stream_copy",
    "stream_change_to_change",
    "stream_update",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sluiceway-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
            storage.release_all(spark)
        seconds[name] = round(statistics.median(times[1:]), 4)
        print(f"{name}: {seconds[name]} s (first {times[0]:.2f})", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
