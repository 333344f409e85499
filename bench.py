"""Time the catalog's queries and print one JSON line.

BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local threads          (default 8)
BENCH_RUNS     runs per query, the fastest counts (default 2)
BENCH_QUERIES  comma-separated names  (default all)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tidemark.plans import catalog
from tidemark.session import configure

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
ONLY = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        # Local folders only: the default manager forks a process per file.
        .config(
            "spark.sql.streaming.checkpointFileManagerClass",
            "org.apache.spark.sql.execution.streaming.checkpointing"
            ".FileSystemBasedCheckpointFileManager",
        )
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    queries = catalog.queries()
    names = ONLY or list(queries)
    timed(queries["feed_kpi_7d"], spark)
    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(queries[name], spark) for _ in range(RUNS)), 4)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of query times, fastest of %d runs" % RUNS,
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
