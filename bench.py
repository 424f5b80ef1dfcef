"""Benchmark: every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is run to completion through the ``noop`` sink (nothing is
collected to the driver): one warm-up pass over all queries, then the
median of ``$BENCH_RUNS`` timed runs per query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluice.plans.catalog import queries  # noqa: E402
from sluice.session import build_session  # noqa: E402

HEADLINE = ["router_batch", "model_classify", "parse_document", "extract_fields", "chain_first", "run_stats"]


def run_once(spark, fn, sf_dir) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t
    spark.catalog.clearCache()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app="sluice-bench", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    registry = {k: v for k, v in queries().items() if not only or k in only}
    failed = {}
    for name, fn in registry.items():
        try:
            run_once(spark, fn, sf_dir)
        except Exception as exc:  # noqa: BLE001 - report the failure, keep timing the others
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    timings = {}
    for name, fn in registry.items():
        if name not in failed:
            timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
    n_docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").count()
    headline = [q for q in HEADLINE if q in timings] or list(timings)
    total = round(sum(timings[q] for q in headline), 3)
    flagship = timings.get("router_batch")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "all_queries_total": round(sum(timings.values()), 3),
        "headline": headline,
        "flagship_docs_per_sec": round(n_docs / flagship, 1) if flagship else None,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
        "failed": failed,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
