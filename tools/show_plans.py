"""Print the executed (AQE final) physical plan of registered analyses,
reduced to the operators that matter for scale.

    python tools/show_plans.py [sf_dir] name ...
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salescope.plans.session import build_session  # noqa: E402
from salescope.registry import QUERIES  # noqa: E402

KEEP = (
    "Exchange",
    "Join",
    "Window",
    "HashAggregate",
    "FileScan",
    "Scan ExistingRDD",
    "Subquery",
    "Reused",
    "Expand",
    "TakeOrdered",
    "BroadcastExchange",
)


def compact(plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]
    out = []
    for line in plan.split("\n"):
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        line = re.sub(r"ReadSchema: struct<[^>]*>", "", line)
        out.append(line[:200].rstrip())
    return "\n".join(out)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    for name in args:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        print(f"### {name}\n```\n{compact(df._jdf.queryExecution().executedPlan().toString())}\n```\n")


if __name__ == "__main__":
    main()
