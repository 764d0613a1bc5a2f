"""Plan profile of every registered query as it would run at scale.

Broadcast by size is limited to 8 KB, which nation, region and tables of a few
rows keep to at any scale; the query runs once on sf0.01, and the final adaptive
plan is summarised. What a query writes and rereads on the way has plans of its own.

    python -m tests.plan_report > /tmp/plans.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = ("rf_", "run_", "feature_importance", "full_refresh_rows", "csv_round_trip_")     # training, plain copies


def main() -> None:
    from __spark_entry__ import queries
    from arrears.plans.inspect import plan_summary
    from arrears.session import build_session
    spark = build_session("local[8]", 16, extra={
        "spark.sql.autoBroadcastJoinThreshold": "8k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "8k"})
    cols = ["scans", "shuffles", "reused_shuffles", "broadcasts", "sort_merge_joins", "windows",
            "hash_aggregates", "sort_aggregates", "nested_loop_joins", "python_udfs"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in sorted(queries().items()):
        if name.startswith(SKIP):
            continue
        s = plan_summary(fn(spark, "/root/testdata/sf0.01"), executed=True)
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
