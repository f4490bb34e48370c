"""Time the headline queries; prints one JSON line.

Every query is planned anew and run to a sink that discards its rows. A first run warms the JVM, then the median of
`BENCH_RUNS` runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from coverlake.checks.queries import QUERIES
from coverlake.session import build_session

# Left out unless named: flows of many small files, whose time is that of the file system.
FILE_FLOWS = {"gold_load", "silver_metrics", "file_checksums"}
HEADLINE = [name for name in QUERIES if name not in FILE_FLOWS]


def run_once(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "coverlake-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
