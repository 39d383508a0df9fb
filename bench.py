"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, writing the full result to the ``noop`` sink, and
prints one JSON line: median seconds of the warm runs per query and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "masking_ops_contract", "log_lines", "config_flatten", "ops_config_join", "ops_own_config",
    "quarantine", "date_drilldown", "fact_by_date", "default_sums_gold", "manifest_documents",
    "activity_feed", "ops_by_date", "masking_ops_landed_lines", "table_lifecycle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    from masklens.plans.catalog import QUERIES
    from masklens.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="masklens-bench")
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:  # warm-up pass over every query (JIT, code generation, file listings)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        fn = QUERIES[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
