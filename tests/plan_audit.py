"""List what in the plans would not scale: keyless joins, one-task windows and sorts, Python stages.

``python -m tests.plan_audit [sf_dir] [name ...]``
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def findings(text: str) -> list[str]:
    found = []
    if "CartesianProduct" in text:
        found.append("cartesian product")
    if "BroadcastNestedLoopJoin" in text:
        found.append("nested-loop join")
    if re.search(r"Window \[.*windowspecdefinition\((?!.*#)", text):
        found.append("window without columns")
    for line in text.splitlines():
        if re.match(r"[\s:+\-|*()0-9]*Window ", line) and re.search(r"\], \[\]|\]$", line.strip()) and not re.search(r"\], \[[^\]]+\]", line):
            found.append("one-task window: " + line.strip()[:160])
    if "ArrowEvalPython" in text or "MapInPandas" in text or "BatchEvalPython" in text:
        found.append("python stage")
    return found


def main(argv: list[str]) -> None:
    from shelfline.session import local_session
    import __spark_entry__ as e

    sf = argv[0] if argv else "/root/testdata/sf0.001"
    spark = local_session("8")
    queries = e.queries()
    for name in argv[1:] or queries:
        plan = queries[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        joins = {k: plan.count(k + " ") for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin") if k + " " in plan}
        print(f"{name}: exchanges={plan.count('Exchange hashpartitioning')} range={plan.count('Exchange rangepartitioning')} single={plan.count('Exchange SinglePartition')} {joins} {findings(plan)}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
