"""Write PLANS.md: a summary of the final (AQE) physical plan of the headline queries.

python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["pipe_features", "win_trailing_mean", "win_daily_lag_mean", "dq_gap_report", "join_left_temperature",
        "cal_interval_flags", "pipe_calendar_features", "prof_describe", "prof_corr_matrix", "smp_hash_fraction",
        "agg_cond_mean", "prof_moments", "dq_outliers_iqr", "fcst_split_report", "ml_threshold_search", "mon_drift"]


def summarize(plan: str) -> dict:
    ex = Counter(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan))
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))
    return {
        "reads": len(re.findall(r"FileScan parquet", plan)),
        "shuffles": dict(ex),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": dict(joins),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "window_group_limit": len(re.findall(r"WindowGroupLimit", plan)),
        "pushed": sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)) - {"[]"}),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
    }


def main(sf: str) -> None:
    from hourwise.session import build_session
    import __spark_entry__ as E

    spark = build_session("local[8]")
    out = ["# Physical plans of the headline queries", "",
           f"Executed (final) plans of a run at `{sf}` on local[8], written by `tests/plan_report.py`.  Tables that a query",
           "materialises while it is built (the hourly series, quantile ranges) are read as Parquet and appear as reads.", ""]
    for k in KEYS:
        df = E.queries()[k](spark, sf)
        df.collect()  # runs this very plan, so that it is final (results are small at this size)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not plan.startswith("AdaptiveSparkPlan isFinalPlan=false"), k  # scalar subqueries print their first plan
        s = summarize(plan.split("== Initial Plan ==")[0])
        out.append(f"## {k}")
        out.append("")
        for name, val in s.items():
            if val:
                out.append(f"* {name}: {val}")
        out.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
