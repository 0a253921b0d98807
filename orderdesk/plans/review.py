"""Plan review: run each check once and summarise its final (post-AQE)
physical plan: shuffles, broadcasts, reused exchanges, join kinds, windows,
Python nodes and the widest parquet read (columns of the scan node).

Usage: ``python -m orderdesk.plans.review [sf_dir] [name ...]`` (markdown table)
"""

from __future__ import annotations

import re
import sys

from . import registry

PATTERNS = {
    "hash shuffle": r"Exchange hashpartitioning",
    "range shuffle": r"Exchange rangepartitioning",
    "round robin": r"Exchange RoundRobinPartitioning",
    "single part.": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "BNLJ": r"BroadcastNestedLoopJoin",
    "window": r"\bWindow \[",
    "python": r"EvalPython|PythonUDF|FlatMapGroupsInPandas|MapInPandas",
}


def final_part(plan: str) -> str:
    """The printed plan without the initial plans that AQE prints below the final ones."""
    out, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def summarise(plan: str) -> dict:
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    widths = [len(m.split(",")) if m else 0 for m in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    out["scans"] = len(widths)
    out["max cols read"] = max(widths) if widths else 0
    return out


def review(spark, names, sf_dir):
    """Runs each DataFrame's own query execution, so that its plan is the final one."""
    for n in names:
        execution = registry.run(spark, n, sf_dir)._jdf.queryExecution()
        execution.toRdd().count()
        plan = execution.executedPlan().toString()
        assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan, n
        yield n, summarise(final_part(plan))


def main(argv):
    from ..session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    registry.load_all()
    spark = build_session()
    keys = None
    for n, s in review(spark, argv[2:] or sorted(registry.CHECKS), sf_dir):
        if keys is None:
            keys = list(s)
            print("| check | " + " | ".join(keys) + " |")
            print("| --- " * (len(keys) + 1) + "|")
        print(f"| {n} | " + " | ".join(str(s[k]) for k in keys) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
