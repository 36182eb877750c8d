"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3).  Every query is run once to warm up, then timed
``BENCH_REPEATS`` times with the ``noop`` sink (the whole plan runs, nothing is
collected); the median is reported.  Building and landing the Bronze snapshot
files is timed once on its own (``land_bronze_once``), apart from decoding them.
``value`` is the sum of the medians of all timed queries and of the landing.  The jobs
that write many partitions (partitioned write, replay, stream, serving upsert) are timed
once each, landing included, and reported beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aerolake.operators.gold import country_metrics  # noqa: E402
from aerolake.plans import register as R  # noqa: E402
from aerolake.plans.pipeline import bronze_to_silver  # noqa: E402
from aerolake.sinks.lake import land_bronze  # noqa: E402
from aerolake.sources.bronze import read_bronze  # noqa: E402
from aerolake.storage import fresh_path  # noqa: E402

HEADLINE = [
    "gold_country_metrics",
    "bronze_states_decode",
    "silver_flight_positions",
    "serving_fold_positions",
    "serving_fold_metrics",
    "busiest_countries_topk",
    "contract_violations",
    "upsert_result",
    "upsert_counts",
    "insert_ignore_result",
]

WRITING = ["silver_partition_roundtrip", "bronze_replay", "incremental_silver", "serving_upsert_positions"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("aerolake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(cpus * 2, 8)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerolake-bench-"))

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def timed(fn) -> float:
        fn()  # warm-up
        samples = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        return round(statistics.median(samples), 3)

    results: dict[str, float] = {}

    # Bronze landing (snapshot building + JSON write), once
    root = fresh_path(spark, "bench-bronze")
    t0 = time.perf_counter()
    land_bronze(R.documents(spark, sf_dir), root)
    results["land_bronze_once"] = round(time.perf_counter() - t0, 3)

    # decode of landed files -> Silver -> country metrics (the reference's run)
    results["files_decode_to_metrics"] = timed(
        lambda: run(country_metrics(bronze_to_silver(read_bronze(spark, root, multi_line=False))))
    )
    for name in HEADLINE:
        fn = R.queries()[name]
        results[name] = timed(lambda fn=fn: run(fn(spark, sf_dir)))

    timed_total = sum(results.values())

    # whole jobs that write hundreds of partitions, timed once and apart from the total
    jobs: dict[str, float] = {}
    for name in WRITING:
        t0 = time.perf_counter()
        run(R.queries()[name](spark, sf_dir))
        jobs[name] = round(time.perf_counter() - t0, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(timed_total, 3),
                "unit": "sec",
                "queries": results,
                "writing_jobs_once": jobs,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
