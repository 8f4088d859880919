"""Count exchanges in final adaptive plans; prints the table of PLANS.md.

Usage: python tools/plan_counts.py [sf_dir] [name ...]

Settings: local[8], 8 shuffle partitions, the session of cargolens/session.py.
Each query is collected once; then the adaptive plan that ran is read.
Reused exchanges are not counted again.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PYTHON = r"(MapInPandas|MapInArrow|PythonMapInArrow|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)"


def counts(plan: str) -> dict[str, int]:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|single|round|rebalance)", final, re.I)),
        "broadcasts": len(re.findall(r"BroadcastExchange ", final)),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "python": len(re.findall(PYTHON, final)),
    }


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from cargolens.plans.catalog import registry
    from cargolens.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    print("| query | shuffles | broadcasts | windows | Python |\n| --- | --- | --- | --- | --- |")
    for name in args or queries:
        df = queries[name](spark, sf_dir)
        df.collect()  # results are small; the plan below is the adaptive one that ran
        n = counts(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | " + " | ".join(map(str, n.values())) + " |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
