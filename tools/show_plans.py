"""Print the physical-plan shape of registered queries: scans (pushed filters,
read schema), exchanges, join strategies, windows and aggregates.

usage: python tools/show_plans.py [sf_dir] name [name ...]
AQE is switched off here only so the static plan is printed in full.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = re.compile(r"Exchange|Join|Window \[|HashAggregate|FileScan|Union|Subquery|Generate|Expand")


def shape(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line.rstrip())
            line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths?\)\[[^\]]*\], ", "", line)
            out.append(line[:200])
    return out


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from kairos.plans.catalog import QUERIES
    from kairos.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for n in names:
        print(f"### {n}\n```")
        print("\n".join(shape(QUERIES[n](spark, sf))))
        print("```\n")


if __name__ == "__main__":
    main()
