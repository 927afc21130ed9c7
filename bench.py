"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "headline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is forced in full with the ``noop`` sink (every row computed, nothing sent
to the driver). One warm-up pass, then the median of ``$BENCH_REPEAT`` timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edpanel.plans import catalog  # noqa: E402
from edpanel.session import get_session  # noqa: E402

HEADLINE = [
    "fact_build",          # lineitem -> provider x month fact (the scan + partial/final aggregate)
    "kpi05",               # 4-hour performance
    "kpi09",               # rank within month (histogram ranks, no whole-period window)
    "kpi12",               # national quartiles (histogram percentiles)
    "geo_rollup",          # rollup ICB / region / national
    "trajectory",          # per-provider rolling windows
    "peer_volume",         # per-period volume bands
    "outliers",            # IQR fences per period
    "scd2_merge",          # revision merge of two releases
    "scd2_rebuild",        # history rebuild from three snapshots
    "cells_to_wide",       # grid render -> parse -> staged rows, end to end
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus) * 2))))
    qs = catalog.queries()
    results: dict[str, float] = {}
    for name in names:
        fn = qs[name]
        run_once(spark, fn, sf_dir)  # warm-up: JIT, file listing, codegen cache
        results[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "repeat": repeat, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
