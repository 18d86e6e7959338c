"""Summarise the physical plan of every registered query (static plan,
before AQE's run-time changes) as a markdown table.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fundlens.plans import registry as E  # noqa: E402
from fundlens.session import get_session  # noqa: E402

EAGER = {"train_score", "grid_search", "model_reload"}


def summarise(p: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (.+?)\s*$", p, flags=re.M)
    scans = re.findall(r"Location: \w+ \[file:[^\]]*/([\w.]+)\]", p)
    pushed = [f for f in re.findall(r"PushedFilters: \[(.*?)\]", p) if f]
    exchanges = [n for n in nodes if n.startswith("Exchange")]
    parts = re.findall(r"Arguments: (hashpartitioning|SinglePartition|RoundRobinPartitioning|rangepartitioning)", p)
    joins = sorted({n.split()[0] for n in nodes if "Join" in n})
    return {
        "scans": ", ".join(sorted(set(s.replace(".parquet", "") for s in scans))) or "-",
        "exchanges": f"{len(exchanges)} ({', '.join(sorted(set(parts)))})" if exchanges else "0",
        "joins": ", ".join(joins) or "-",
        "partial_agg": "yes" if "partial_" in p else "-",
        "pushed": "; ".join(sorted(set(pushed)))[:90] or "-",
        "python": "yes" if ("ArrowEvalPython" in p or "BatchEvalPython" in p) else "-",
        "topk": "yes" if "TakeOrderedAndProject" in p else "-",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    print(f"# Physical plans\n\nStatic plans (before AQE) of every registered query at `{sf_dir}`, "
          "from `tools/plan_report.py`. The model queries fit while they are built and are left out.\n")
    print("| query | scans | exchanges | joins | partial agg | top-k | python | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in E.queries().items():
        if name in EAGER:
            continue
        df = q(spark, sf_dir)
        p = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarise(p)
        print(f"| {name} | {s['scans']} | {s['exchanges']} | {s['joins']} | {s['partial_agg']} | "
              f"{s['topk']} | {s['python']} | {s['pushed']} |")


if __name__ == "__main__":
    main()
