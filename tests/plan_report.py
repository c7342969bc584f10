"""Summarise the physical plan of every registered query.

python tests/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange), join strategies, partial top-k
(WindowGroupLimit), windows, Python nodes, and what the scans read.  The
plan is the initial adaptive plan (AQE may still coalesce partitions or
turn a sort-merge join into a broadcast at run time).
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, ".")

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    c = Counter()
    scans = []
    seen, skip_depth = set(), None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip_depth is not None:
            if depth > skip_depth:
                continue
            skip_depth = None
        sub = re.search(r"(?:Subquery|ReusedSubquery) subquery#?(\d*), \[id=#?(\d+)\]", line)
        if sub:
            if sub.group(2) in seen:       # the same subquery printed again: count it once
                skip_depth = depth
                continue
            seen.add(sub.group(2))
        body = line.strip(" :+-*()0123456789")
        if body.startswith("Exchange"):
            kind = "single" if "SinglePartition" in body else (
                "range" if "rangepartitioning" in body else "hash")
            c[f"exchange:{kind}"] += 1
        elif body.startswith("BroadcastExchange"):
            c["broadcast"] += 1
        for j in JOINS:
            if body.startswith(j):
                c[j] += 1
        if body.startswith("WindowGroupLimit"):
            c["WindowGroupLimit"] += 1
        elif body.startswith("Window"):
            c["Window"] += 1
        if body.startswith(("ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")):
            c["python"] += 1
        if "FileScan" in body:
            m = re.search(r"FileScan (\w+) \[([^\]]*)\]", body)
            if m:
                loc = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]*)\]", body)
                name = loc.group(1).rstrip("/").rsplit("/", 1)[-1] if loc else "?"
                name = re.sub(r"-[0-9a-f]{12}$", "", name)
                cols = [re.sub(r"#\d+L?", "", x) for x in m.group(2).split(",")]
                pushed = re.search(r"PushedFilters: \[([^\]]*)\]", body)
                scans.append(f"{name}({len(cols)} cols{'; pushed' if pushed and pushed.group(1) else ''})")
    return {"ops": dict(sorted(c.items())), "scans": sorted(set(scans))}


def main(argv):
    import __spark_entry__ as entry
    from gleaner.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print(f"# Physical plans of the registered queries ({sf_dir.rsplit('/', 1)[-1]})\n")
    print("Generated by `python tests/plan_report.py`. `exchange:hash` / `range` / `single` are shuffles;")
    print("`broadcast` is a broadcast exchange (size-checked); `WindowGroupLimit` is a top-k applied before")
    print("the shuffle; `python` counts Arrow-batched Python nodes. Scans list the columns they read and")
    print("whether filters were pushed into them. A scalar subquery printed at several references (same")
    print("id, executed once) is counted once.\n")
    print("| query | operators | scans |")
    print("|---|---|---|")
    for name, build in sorted(entry.queries().items()):
        df = build(spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        ops = ", ".join(f"{k} x{v}" for k, v in s["ops"].items()) or "-"
        print(f"| {name} | {ops} | {', '.join(s['scans'])} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
