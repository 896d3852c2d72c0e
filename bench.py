"""Benchmark the headline operators; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1; the best of N runs is reported per query).
Every query is fully executed through the `noop` sink (all rows produced, nothing
collected to the driver). Before timing, each query runs once on the small sf0.001
tables (JVM class loading / JIT warm-up, not counted); then each is timed on the
target tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans import registry  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = [
    "dq_valid_dedup", "dq_metrics", "dq_all_violations", "cdc_merge", "cdc_late_change",
    "scd2_apply", "fact_star_join", "fact_temporal_join", "chk_fact_grain", "dim_order",
    "chk_reconcile", "fk_orphans", "rls_scoped", "layout_same_rows", "fact_production",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = local_session(cpus, shuffle_partitions=max(8, cpus), app="strata-bench")
    qs = registry.queries()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
