"""Benchmark the daily build stage by stage; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each timed step forces full computation with the ``noop`` sink (no collect);
stages the pipeline re-uses (batches, postings, candidates, matches, breaks)
are checkpointed once, as in production, and counted in the step that
builds them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tillbook.session import build_session
    from tillbook.plans.pipeline import Pipeline
    from tillbook.plans.queries import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)), app="tillbook-bench")
    p = Pipeline(spark, sf_dir)
    timings: dict[str, float] = {}

    def run(name: str, thunk) -> None:
        t0 = time.perf_counter()
        df = thunk()
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    t_all = time.perf_counter()
    # headline chain, in build order (the first job also pays JVM/codegen warm-up)
    run("calendar", lambda: p.calendar)
    run("settlement_batches", lambda: p.batches)
    run("bank_movements", lambda: p.bank_movements)
    run("recon_matches", lambda: p.matches)
    run("reconciliation_breaks", lambda: p.breaks)
    for name in ["daily_cash_position", "funding_cost_summary", "merchant_exception_trends",
                 "merchant_settlement_sla", "duplicate_postings", "exception_queue", "exception_queue_second_run",
                 "run_summary", "silver_transaction", "dim_date"]:
        run(name, lambda n=name: QUERIES[n](p))
    total = round(time.perf_counter() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "daily_build_total", "value": total, "unit": "sec", "queries": timings,
                      "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
