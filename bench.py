"""Times the headline queries and prints one JSON line.

Every query runs to the end into a sink that drops the rows. Reported is the
faster of two runs, so that the time to start up the JVM's compiled code, which
a long-running cluster pays once, does not drown the work.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from cashweave.registry import registered  # noqa: E402

HEADLINE = [
    "level1",
    "level2a",
    "level2b",
    "va_txn_flows",
    "va_txn",
    "flows_pivot",
    "inter_sku_transfers",
    "transfer_totals",
    "categorise_case",
    "categorise_join",
    "typed_ledger",
    "check_totals",
    "load_mapping",
]
RUNS = 2


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cash reconciliation bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites of every Column are recorded otherwise, at twice the cost.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of headline queries, faster of two runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(directory).name.removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
