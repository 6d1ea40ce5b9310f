"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list),
BENCH_REPEATS (default 2: the first run of a query warms it up, the fastest counts).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lossledger.plans.catalog import QUERIES
from lossledger.session import build_session

HEADLINE = [
    "asof_statement", "payment_rollup", "latest_payment", "ratio_mart", "lgd_sample", "staging_sample",
    "migration_matrix", "ecl_facility", "ecl_by_stage", "ecl_cube", "stress_summary", "data_quality",
    "winsorized_ratios", "pd_time_split", "binary_metrics", "pd_calibration_bins", "quantile_calibration_bins",
    "pd_backtest", "psi_summary", "lgd_by_segment",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(cpus), spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            spark.catalog.clearCache()  # nothing kept from the run before
            started = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name}
        )
    )


if __name__ == "__main__":
    main()
