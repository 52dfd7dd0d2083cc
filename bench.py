"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and executed end to end (``noop`` sink: the full plan runs, nothing is
collected to the driver): one warm-up run, then the median of ``BENCH_REPS`` timed runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["model_sessions", "model_leads", "model_roi_monthly", "model_price_plans", "html_cards_enriched",
            "upsert_latest", "ingest_raw_rows"]


def cpu_calibration() -> float:
    """Seconds for a fixed pure-Python loop: tells machine slowdowns apart from code changes."""
    t0 = time.perf_counter()
    s = 0
    for i in range(5_000_000):
        s += i
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE

    from tidewater.harness.catalog import QUERIES
    from tidewater.session import build_session, remove_tables

    spark = build_session(f"local[{cpus}]", app="tidewater-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings = {}
    for name in names:
        run(name)                                   # warm-up: JIT, file listing, Python workers
        timings[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
    remove_tables(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "reps": reps, "cpu_calibration_sec": cpu_calibration()}))


if __name__ == "__main__":
    main()
