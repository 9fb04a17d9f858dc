"""Write PLANS.md: the physical operators of every registered (non-model) query.

    python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.inspect import plan_string  # noqa: E402
from tessera.plans.queries import REGISTRY  # noqa: E402
from tessera.session import get_session  # noqa: E402

MODEL = {"als_fit", "als_mse", "als_grid", "als_recommend", "credit_fit", "credit_score", "credit_score_saved"}
# Each physical operator has one "(id) Name" details entry in the formatted plan.
COUNTED = [(n, rf"^\(\d+\) {n}\b") for n in (
    "Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin",
    "TakeOrderedAndProject", "Window",
)] + [("Subquery", r"^Subquery:\d+")]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    out = [
        "# PLANS — physical operators per query",
        "",
        f"Generated by `scripts/plan_report.py` from `explain('formatted')` at `{sf_dir}` (initial",
        "adaptive plans; AQE may still coalesce partitions or turn a sort-merge join into a",
        "broadcast at run time). Counts are of physical operators in the whole plan,",
        "subqueries included. Model queries (ALS, forest) are omitted.",
        "",
        "| query | " + " | ".join(n for n, _ in COUNTED) + " |",
        "| --- | " + " | ".join("---" for _ in COUNTED) + " |",
    ]
    trees = []
    for name, fn in REGISTRY.items():
        if name in MODEL:
            continue
        text = plan_string(fn(spark, sf_dir), "formatted")
        counts = [str(len(re.findall(p, text, re.M))) for _, p in COUNTED]
        out.append(f"| `{name}` | " + " | ".join(counts) + " |")
        trees.append((name, text.split("\n\n")[0].strip()))
    out += ["", "## Plan trees", ""]
    for name, tree in trees:
        out += [f"### {name}", "", "```", tree, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
