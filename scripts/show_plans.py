"""Summarise the physical plans of the marts (both plans) and optionally print them.

Usage: python scripts/show_plans.py [sf_dir] [--full]
Counts come from the static plan (AQE off for the count, so every shuffle
the plan can need is visible); AQE at run time may turn sort-merge joins
into broadcast joins or split skewed partitions.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpimart.plans import TEST_PARAMS, build, test_inputs  # noqa: E402
from kpimart.plans.registry import TIE  # noqa: E402
from kpimart.session import get_session  # noqa: E402

PATTERNS = {
    "scans": r"FileScan parquet",
    "shuffles": r"Exchange hashpartitioning",
    "reused": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "group_limit_partial": r"WindowGroupLimit .*Partial",
    "python_udf": r"BatchEvalPython|ArrowEvalPython",
}


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    full = "--full" in sys.argv
    spark = get_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    inputs = test_inputs(spark, sf)
    print("| mart | plan | " + " | ".join(PATTERNS) + " |")
    print("|---|---|" + "---|" * len(PATTERNS))
    for name in ("calendar", "violations", "permits", "inspections"):
        for plan in ("plain", "onepass"):
            df = build(name, inputs, TEST_PARAMS, plan, TIE)
            text = df._jdf.queryExecution().executedPlan().toString()
            counts = [len(re.findall(p, text)) for p in PATTERNS.values()]
            print(f"| {name} | {plan} | " + " | ".join(str(c) for c in counts) + " |")
            if full:
                df.explain("formatted")
            if name == "calendar":
                break


if __name__ == "__main__":
    main()
