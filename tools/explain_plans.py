"""Print the final (adaptive) physical-plan skeleton of registered queries.

usage: python tools/explain_plans.py [sf_dir] [name ...] > PLANS.md
Only operator lines are kept: scans (with pushed filters and read schema),
exchanges, aggregates, windows, joins, generators and reused stages.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetspark.plans import catalog  # noqa: E402
from fleetspark.session import build_session  # noqa: E402

INTRO = """Generated by `python tools/explain_plans.py /root/testdata/sf0.01 <names>`; operator lines only.
What to look for: partial/final aggregate pairs around each `Exchange hashpartitioning`
(map-side combine), one `FileScan` per input in the run operators (the summary branch reads
the reused shuffle), and the lookup by model joined as `BroadcastHashJoin` without an exchange of
the fleet by model. `SortAggregate` marks aggregates with string/struct buffers (`max_by`/`min_by`
over structs or strings): they combine map-side, sorting locally instead of hashing.
"""

KEEP = re.compile(r"(FileScan|Exchange|Aggregate|Window|Join|Generate|Reused|TakeOrdered|Subquery|Sort \[)")


def final_plan(df) -> str:
    """Final plan of the query as run. Each adaptive node (also that of a subquery) prints its final plan and
    then its initial one, which is left out."""
    df.collect()
    kept, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-|"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def skeleton(df) -> list[str]:
    plan = final_plan(df)
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: [^,]*, ", "", line)
            out.append(line.rstrip()[:180])
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or sorted(catalog.QUERIES)
    spark = build_session("local[8]")
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print(INTRO)
    for n in names:
        print(f"## {n}\n\n```")
        print("\n".join(skeleton(catalog.run(n, spark, sf_dir))))
        print("```\n")


if __name__ == "__main__":
    main()
