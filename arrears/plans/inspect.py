"""Plan summaries: what a query shuffles, broadcasts, windows and scans.

Used by the tests to pin plan properties, and handy when iterating on a query:
``plan_summary(df)`` counts the physical operators that matter at scale.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition",
    "reused_shuffles": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "sort_merge_joins": r"SortMergeJoin",
    "broadcast_joins": r"BroadcastHashJoin",
    "nested_loop_joins": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow \[",
    "hash_aggregates": r"HashAggregate\(",
    "sort_aggregates": r"SortAggregate\(",
    "python_udfs": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "scans": r"FileScan|Scan parquet|InMemoryTableScan",
}


def physical_plan(df: DataFrame, executed: bool = False) -> str:
    """The physical plan text; with ``executed`` the query runs first so that
    the adaptive plan is final (shuffle reuse, runtime join choices)."""
    if executed:
        # Run this DataFrame's own query execution (a write would plan a new
        # one) without bringing rows to the driver.
        df.foreachPartition(lambda rows: None)
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def plan_summary(df: DataFrame, executed: bool = False) -> dict:
    text = physical_plan(df, executed)
    return {k: len(re.findall(p, text)) for k, p in _PATTERNS.items()}
