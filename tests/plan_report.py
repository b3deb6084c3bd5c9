"""Physical-plan summary of every catalogue query (writes PLANS.md).

    python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from kiln.plans.inspect import plan_text  # noqa: E402


def summarize(text: str) -> dict:
    lines = text.splitlines()
    tree = [l for l in lines if re.match(r"^[\s+\-*:|]*[A-Z][A-Za-z]+( [A-Za-z]+)*\s+\(\d+\)", l)]
    ops = [re.sub(r"^[\s+\-*:|]*", "", l).split(" (")[0].strip() for l in tree]
    shuffles = [l for l in lines if l.startswith("Arguments: ") and ("hashpartitioning" in l or "rangepartitioning" in l or "SinglePartition" in l)]
    kinds = []
    for l in shuffles:
        m = re.search(r"(hashpartitioning|rangepartitioning)\((.*), \d+\)", l)
        if m:
            keys = re.sub(r"#\d+L?", "", m.group(2)).replace(" ASC NULLS FIRST", "").replace(" DESC NULLS LAST", " DESC")
            kinds.append(f"{m.group(1).replace('partitioning', '')}({keys})")
        else:
            kinds.append("single")
    pushed = [re.sub(r"#\d+L?", "", l.split("PushedFilters: ")[1]) for l in lines if "PushedFilters: [" in l and "PushedFilters: []" not in l]
    return {
        "scans": sum(1 for o in ops if o.startswith("Scan")),
        "shuffles": kinds,
        "broadcast": sum(1 for o in ops if o == "BroadcastExchange"),
        "special": sorted({o for o in ops if o in ("TakeOrderedAndProject", "WindowGroupLimit", "BroadcastHashJoin", "SortMergeJoin", "Expand", "Generate")}),
        "pushed": pushed,
        "python": any("EvalPython" in o or "FlatMapGroupsInPandas" in o for o in ops),
    }


def main(argv):
    from kiln.session import local_session

    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the plan chosen at scale
    print("# Physical plans of the catalogue queries\n")
    print(f"Generated by `tests/plan_report.py` on `{sf_dir}` with size-based automatic broadcast disabled")
    print("(what the planner picks once tables are large; checked broadcasts of bounded sides still appear).")
    print("Queries that write first (round trips, tables, streams) show the plan of the DataFrame they return.\n")
    print("| query | scans | shuffles (partitioning) | broadcasts | notable operators | pushed filters | Python |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in E.queries().items():
        s = summarize(plan_text(fn(spark, sf_dir), "formatted"))
        print(
            f"| `{name}` | {s['scans']} | {', '.join(s['shuffles']) or '—'} | {s['broadcast'] or '—'} | "
            f"{', '.join(s['special']) or '—'} | {'; '.join(p[:80] for p in s['pushed']) or '—'} | {'yes' if s['python'] else 'no'} |"
        )


if __name__ == "__main__":
    main(sys.argv)
