"""Write PLANS.md: per registered query, the shape of its executed plan at sf0.1.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)\(?([^)\n]*)", plan)
    keys = []
    for kind, args in exchanges:
        cols = re.findall(r"([A-Za-z_][A-Za-z0-9_]*)#\d+", args)
        keys.append(f"{kind.replace('partitioning', '')}({', '.join(cols)})" if cols else kind)
    return {
        "scans": plan.count("FileScan"),
        "pushed": sorted(set(f for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
                             for f in re.findall(r"EqualTo\([^)]*\)", p))),
        "exchanges": keys,
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan))),
        "group_limit": "WindowGroupLimit" in plan,
    }


def main() -> None:
    from roadwatch.session import build_session
    from roadwatch.plans.queries import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("# Plans of the registered queries\n")
    print(f"Generated by `python tests/plan_report.py` on `{os.path.basename(sf)}` after execution "
          "(adaptive plans final). Exchange keys list the shuffles; `_part` is a key with its bucket, "
          "`_hb`/`_jb` are time buckets, so no shuffle is keyed by a car or area alone except "
          "one-row-per-bucket summaries. `reused` counts exchanges read a second time.\n")
    print("| query | scans | reused | pushed filters | shuffles (keys) | broadcasts | joins |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        s = summarize(plan)
        ex = "; ".join(s["exchanges"]) + (" + group limit" if s["group_limit"] else "")
        print(f"| {name} | {s['scans']} | {plan.count('ReusedExchange')} | {', '.join(s['pushed']) or '-'} | {ex or '-'} | "
              f"{s['broadcasts']} | {', '.join(s['joins']) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
