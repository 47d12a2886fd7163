"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to the ``noop`` sink (full execution, nothing collected),
median of $BENCH_REPEATS runs after one warm-up pass.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("RUMBO_ROW_GROUP_BYTES", str(2 * 1024 * 1024))     # few-MB test tables
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rumbo.plans.registered import REGISTRY  # noqa: E402
from rumbo.session import local_session  # noqa: E402
from rumbo.sources.warehouse import standin_warehouse  # noqa: E402

HEADLINE = [
    "customer_core", "contract_initial_load", "overdraft_master", "overdraft_journey", "fund_interest",
    "pension_interest", "young_retention", "home_insurance_expiry",
    "latest_row_per_key", "propensity_multi_model", "overdraft_transition", "composite_key_join",
    "anti_join_composite", "text_classify",
]


def run(spark, key: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):        # stage / task times without the UI
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="rumbo-bench", extra=extra)
    t0 = time.perf_counter()            # stand-in warehouse, written once per data set
    standin_warehouse(spark, sf_dir).build_all()
    build = round(time.perf_counter() - t0, 3)
    for k in keys:                      # warm-up: JIT, file listing, codegen cache
        run(spark, k, sf_dir)
    times = {k: round(statistics.median(run(spark, k, sf_dir) for _ in range(repeats)), 3) for k in keys}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "standin_build_sec": build, "cpus": cpus, "repeats": repeats,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
