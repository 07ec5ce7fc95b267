"""Summarise the final (post-AQE) physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query runs once (noop sink); counted from the executed plan: shuffle
exchanges, broadcast exchanges, sorts, window operators, Python evaluation
nodes (must be 0) and Parquet scans with their pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tillbook.session import build_session
    from tillbook.plans.pipeline import Pipeline
    from tillbook.plans.queries import QUERIES

    spark = build_session("local[8]", 16)
    p = Pipeline(spark, sf_dir)
    print(f"# Physical plans ({sf_dir}, post-AQE, after materialised stages)\n")
    print("Stages re-used by several queries are written once as Parquet (see README); the counts below are for")
    print("each query's own plan on top of them. `python` = ArrowEvalPython/BatchEvalPython nodes (UDFs).\n")
    print("| query | shuffles | broadcasts | joins | sorts | windows | python | scans (with pushed filters) |")
    print("|---|---|---|---|---|---|---|---|")
    rows = [(name, fn(p)) for name, fn in QUERIES.items()]
    table(rows)
    # the stages the queries start from, as built (each is written once as a Parquet table)
    from tillbook.operators import matching as M
    from tillbook.operators import settlement
    from pyspark.sql import functions as F
    w = M.batch_windows(p.batches, p.calendar, p.policy)
    cands = p.recon.candidates
    first = p.recon.pass_one
    split, lines = M.split_sums(cands, first)
    single = first.where(F.col("single_posting_id").isNotNull()).select(M.ID)
    open_b = w.join(single.unionByName(split.select(M.ID)), M.ID, "left_anti")
    stages = [
        ("stage: settlement_batches", settlement.settlement_batches(p.daily_volume, p.merchants, p.returns,
                                                                    p.calendar, p.policy)),
        ("stage: candidates (window days x postings)", M.candidate_pairs(w, p.bank_movements)),
        ("stage: pass_one (batch-best x posting-best + closest)", M.pass_one(cands)),
        ("stage: pass_two split matches", split),
        ("stage: late search (open batches)", M.first_late(open_b, p.bank_movements)),
    ]
    print("\n## Stage plans (the materialised stages above, as built)\n")
    print("| stage | shuffles | broadcasts | joins | sorts | windows | python | scans (with pushed filters) |")
    print("|---|---|---|---|---|---|---|---|")
    table(stages, header=False)
    spark.stop()


def table(rows, header=True) -> None:
    for name, df in rows:
        plan = final_plan(df)
        shuffles = len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bcasts = len(re.findall(r"\bBroadcastExchange\b", plan))
        sorts = len(re.findall(r"\bSort \[", plan))
        windows = len(re.findall(r"\bWindow \[", plan))
        joins = (f"{len(re.findall(r'SortMergeJoin', plan))} SMJ / {len(re.findall(r'BroadcastHashJoin', plan))} BHJ"
                 f" / {len(re.findall(r'BroadcastNestedLoopJoin|CartesianProduct', plan))} NL")
        python = len(re.findall(r"EvalPython", plan))
        scans = re.findall(r"FileScan parquet [^\[]*\[[^\]]*\][^\n]*?PushedFilters: \[([^\]]*)\]", plan)
        scan_txt = f"{len(scans)}" + (f" ({sum(1 for s in scans if s)} with filters)" if scans else "")
        print(f"| {name} | {shuffles} | {bcasts} | {joins} | {sorts} | {windows} | {python} | {scan_txt} |")


if __name__ == "__main__":
    main()
