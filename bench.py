"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed ``BENCH_RUNS`` times (default
3); a run executes the whole plan into the ``noop`` sink (no driver
collect).  Prints ONE JSON line: total of the per-query medians plus the
per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "table_website",            # flagship: latest -> mapped -> outside exclusions -> served horizons
    "table_panel_latest",
    "table_panel_2d",
    "latest_version",
    "forward_fill_rating",
    "implied_rating",
    "anti_exclusion_interval",
    "mut_upsert",
    "mut_forward_fill",
    "melt_wide",
    "prep_pd_daily",
    "dq_missing_counts",
    "join_event_enriched",
    "src_matrix_scan",
    "sort_by_date",
    "mut_commit_partitions",
    "job_pd_range",
    "job_pd_day_reconcile",
    "job_pd_backfill",
    "job_daily_run",
    "job_as_revision",
    "stream_ingest_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [a for a in sys.argv[1:]] or HEADLINE

    from riskloom.plans import catalog
    from riskloom.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:  # warm-up pass: JIT, Python workers, file metadata
        run_once(name)
    results: dict[str, float] = {}
    for name in names:
        results[name] = round(statistics.median(run_once(name) for _ in range(runs)), 3)

    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
