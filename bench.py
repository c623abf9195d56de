"""Bench: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print ONE JSON line with per-query seconds.

Each query is fully executed with the ``noop`` sink (all rows computed, none
shipped to the driver).  Each query runs twice: the first (cold) run pays
for code generation of its plan shape, the second (warm) run is the
reported time; the cold total is reported alongside.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obsengine.plans.queries import REGISTRY  # noqa: E402
from obsengine.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus)
    REGISTRY["total_flights"](spark, "/root/testdata/sf0.001").collect()  # warm-up
    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, fn in REGISTRY.items():
        if only and name not in only:
            continue
        for runs in (cold, timings):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
