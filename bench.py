"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line.

Each query runs in full (its rows go to Spark's noop sink): once to warm up, then $BENCH_RUNS
times; the median counts. ``value`` is the sum over all queries.

``layers`` times one run from CSV files to all gold tables, including every write and log entry:
seconds per layer, and per target table as the run log has them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from claimlake.config import BRONZE, GOLD, SILVER, PipelineConfig  # noqa: E402
from claimlake.plans import audit, bronze, gold, silver  # noqa: E402
from claimlake.sources.store import TableStore  # noqa: E402
from workload.files import CLAIMS_FILE, write_input_files  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def time_layers(spark: SparkSession, sf_dir: str, scratch: str) -> dict:
    write_input_files(spark, sf_dir, f"{scratch}/files")
    store = TableStore(spark, PipelineConfig(f"{scratch}/files/{CLAIMS_FILE}", f"{scratch}/files"))
    store.create_namespaces()
    result = {}
    for layer, run in ((BRONZE, bronze.run_bronze), (SILVER, silver.run_silver), (GOLD, gold.run_gold)):
        started = time.perf_counter()
        run(store)
        result[layer] = round(time.perf_counter() - started, 3)
        for row in audit.recent_runs(store, layer).collect():
            result[f"{layer}.{row['target'].split('`')[-2]}"] = round(row["duration_seconds"], 3)
    return result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="run-")
    spark = session(cpus, scratch)
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    layers = time_layers(spark, sf_dir, scratch)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "layers": layers,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
