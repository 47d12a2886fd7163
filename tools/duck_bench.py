"""Time the DuckDB oracle SQL on one node (stand-ins materialised first).

Usage: python tools/duck_bench.py [sf_dir] [threads]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ["RUMBO_ORACLE_MATERIALIZED"] = "1"
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from oracle.queries import SQL  # noqa: E402
from oracle.standins import DEPENDS, VIEWS  # noqa: E402
from tools.compare import TABLES  # noqa: E402

HEADLINE = ["customer_core", "contract_initial_load", "overdraft_master", "overdraft_journey", "fund_interest",
            "pension_interest", "young_retention", "home_insurance_expiry", "latest_row_per_key",
            "propensity_multi_model", "overdraft_transition", "composite_key_join", "anti_join_composite",
            "text_classify"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads={threads}")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    t0 = time.perf_counter()
    done = set()
    for name in VIEWS:
        for dep in DEPENDS.get(name, []) + [name]:
            if dep not in done:
                con.execute(f"CREATE TABLE {dep} AS {VIEWS[dep]}")
                done.add(dep)
    build = round(time.perf_counter() - t0, 3)
    times = {}
    for k in HEADLINE:
        con.execute(SQL[k]).fetchall()
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            con.execute(SQL[k]).fetchall()
            runs.append(time.perf_counter() - t)
        times[k] = round(statistics.median(runs), 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "sf_dir": sf_dir, "build_sec": build,
                      "value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main()
