"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each figure is the median of three warm runs. Names with ``wh_`` are views over a warehouse
that has landed and loaded all events before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "v02_ingestion_metrics",
    "v03_active_badges",
    "v04_end_to_end_latency",
    "v05_data_freshness",
    "v06_data_quality_metrics",
    "v07_partition_efficiency",
    "v08_streaming_costs",
    "v09_task_execution_history",
    "v10_streaming_client_metrics",
    "src02_json_fields",
    "src09_validated_events",
    "win01_latest_copy",
    "inc05_batch_dedupe",
    "inc07_unknown_users",
    "join02_known_zones",
    "join03_unloaded_events",
    "q05_orphan_events",
    "q14_slowest_queries",
    "x02_dwell_times",
    "x06_latency_distribution",
    "inc03_micro_batch_load",
    "inc12_hourly_stream",
)


VIEWS = (
    "channel_status", "ingestion_metrics", "end_to_end_latency", "data_freshness",
    "data_quality_metrics", "streaming_costs", "task_execution_history",
    "streaming_client_metrics",
)
RUNS = 3


def timed(build) -> float:
    """Median seconds of the runs after the first."""
    seconds = []
    for _run in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    from pyspark.sql import SparkSession

    from gatelog.catalog.all import QUERIES
    from gatelog.catalog.feeds import Feeds
    from gatelog.catalog.incremental import loaded
    from gatelog.plans import views
    from gatelog.streaming import ingest

    folder = tempfile.TemporaryDirectory(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gatelog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", f"file://{folder.name}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {n: timed(lambda n=n: QUERIES[n](spark, SF_DIR)) for n in HEADLINE}
    tables, now = loaded(Feeds(spark, SF_DIR), "bench"), ingest.utc_now()
    for name in VIEWS:
        seconds[f"wh_{name}"] = timed(lambda n=name: getattr(views, n)(tables, now))
    spark.stop()
    folder.cleanup()
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
