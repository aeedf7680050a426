"""Time the headline queries and print one line of JSON.

BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)

A time covers building the plan, jobs that a query runs while it is built, and
evaluating every result row. One untimed pass over all queries warms the JVM;
then the median of three timed passes counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from tidemark.plans.queries import QUERIES

HEADLINE = (
    "hourly_aggregate",
    "hourly_rounded",
    "hourly_exact",
    "json_extract",
    "bronze_rows",
    "silver_hourly",
    "silver_upsert",
    "incremental_refresh",
    "incremental_filter",
    "entity_increment",
    "dictionary_lookup",
    "partitioned_append",
    "expect_compound_unique",
    "suite_bronze",
    "suite_silver",
    "validation_results",
    "runlog_tail",
    "end_to_end_refresh",
    "streaming_refresh",
)
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def evaluate(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = tuple(QUERIES) if wanted == "all" else tuple(filter(None, wanted.split(",")))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    chosen = names or HEADLINE
    passes = [{name: evaluate(spark, name, sf_dir) for name in chosen} for _ in range(1 + RUNS)]
    seconds = {
        name: round(statistics.median(timed[name] for timed in passes[1:]), 3) for name in chosen
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
