"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5; the median run is reported per query).

Timing includes bringing every result row to Python, like the orientation timings in
results; each query rebuilds the landed events from the ``events`` table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costpulse.plans import registry  # noqa: E402
from costpulse.session import get_spark  # noqa: E402

HEADLINE = (
    "llm_events_landed",
    "cost_rollup_60m",
    "cost_rollup_1d",
    "anomalies_5m",
    "anomalies_60m",
    "anomalies_1d",
    "kpis",
    "event_rate",
    "error_rate",
    "live_feed",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "5")))
    spark = get_spark("costpulse-bench", master=f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    # Warm the JVM (class loading, codegen caches) on the smallest query shape.
    registry.REGISTRY["kpi_requests"].plan(spark, sf_dir).toPandas()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            result = registry.REGISTRY[name].plan(spark, sf_dir).toPandas()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        rows[name] = len(result)
    version = spark.version
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "spark": version,
    }))


if __name__ == "__main__":
    main()
