"""Write PLANS.md: for every registered query, what its executed (final adaptive) plan does -
shuffles, broadcasts, scans with the columns they read and the filters pushed into them, and any
Python evaluation.

    python scripts/plan_report.py [--sf /root/testdata/sf0.01] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    # a finished adaptive plan prints the final plan, then the initial one: keep the final plan only
    text = plan.split("== Initial Plan ==")[0]
    lines = text.split("\n")
    out = {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", text)),
        "range_shuffles": len(re.findall(r"Exchange rangepartitioning", text)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", text)),
        "round_robin": len(re.findall(r"Exchange RoundRobinPartitioning", text)),
        "broadcasts": len(re.findall(r"BroadcastExchange", text)),
        "reused": len(re.findall(r"ReusedExchange", text)),
        "python": len(re.findall(r"(ArrowEvalPython|BatchEvalPython|PythonMapInArrow|MapInArrow|FlatMapGroupsInPandas)", text)),
        "windows": len(re.findall(r"\bWindow \[", text)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", text)),
        "broadcast_joins": len(re.findall(r"Broadcast(Hash|NestedLoop)Join", text)),
        "scans": [],
    }
    for ln in lines:
        m = re.search(r"FileScan (\w+) \[([^\]]*)\].*?(PushedFilters: \[[^\]]*\])?", ln)
        if m:
            cols = [c.split("#")[0] for c in m.group(2).split(",") if c.strip()]
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            out["scans"].append((m.group(1), cols, pf.group(1) if pf else ""))
    return out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    a = ap.parse_args()
    from ledgerlens.plans import REGISTRY
    from ledgerlens.session import get_session
    # joins as on large inputs: nothing is broadcast for being small, only where the code says so; whole metadata
    spark = get_session("local[8]", shuffle_partitions=16, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "100000", "spark.sql.debug.maxToStringFields": "1000"})
    rows = []
    for name, e in REGISTRY.items():
        df = e.fn(spark, a.sf)
        qe = df._jdf.queryExecution()
        df.collect()  # after running, the adaptive plan is the final one
        plan = qe.executedPlan().toString()
        rows.append((name, summarize(plan)))
    spark.stop()
    with open(a.out, "w") as fh:
        fh.write("# Executed plans\n\nGenerated by `scripts/plan_report.py` at "
                 f"`{os.path.basename(a.sf)}` (local[8], AQE on, no broadcast for being "
                 "small).  Per registered query: shuffles by kind, "
                 "broadcast exchanges, reused exchanges, joins, window operators, Python stages, and each "
                 "file scan with the columns it reads and the filters pushed into it.  Queries that "
                 "stage a table, write or stream are shown from the last written table on.\n\n")
        fh.write("| query | hash | range | single | rr | bcast | reused | BHJ/BNLJ | SMJ | window | python | scans (columns; pushed filters) |\n")
        fh.write("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |\n")
        for name, s in rows:
            scans = "<br>".join(f"{fmt}: {', '.join(cols)}" + (f"; `{pf}`" if pf else "") for fmt, cols, pf in s["scans"])
            fh.write(f"| `{name}` | {s['hash_shuffles']} | {s['range_shuffles']} | {s['single_partition']} | "
                     f"{s['round_robin']} | {s['broadcasts']} | {s['reused']} | {s['broadcast_joins']} | "
                     f"{s['sort_merge_joins']} | {s['windows']} | {s['python']} | {scans} |\n")
    print(f"wrote {a.out} ({len(rows)} queries)")


if __name__ == "__main__":
    main()
