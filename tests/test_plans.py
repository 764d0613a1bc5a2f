"""Physical-plan properties that matter at scale."""

import pytest

from arrears.plans.catalog import QUERIES
from arrears.plans.inspect import physical_plan, plan_summary
from tests.conftest import SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# These write and read back before they return, or train a model.
EAGER = tuple("rf_ run_ csv_ full_refresh streamed feature_importance".split())


def queries():
    return QUERIES


def _plan(df) -> str:
    return physical_plan(df)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_no_cross_join_no_python_udf(spark, name):
    plan = _plan(queries()[name](spark, SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_delinquency_reads_payments_once_and_prunes_ids(spark):
    plan = _plan(queries()["loan_delinquency"](spark, SMALL))
    assert plan.count("lineitem.parquet") == 1
    assert "Window" not in plan           # payment_id is never computed
    assert "SortAggregate" not in plan     # latest payment stays a hash aggregate


def test_recommendation_adds_no_exchange(spark):
    # Options are generated and ranked inside each row: no join, no extra shuffle
    # beyond what the feature table needs (unused payment stats are even pruned).
    feats = _plan(queries()["loan_features"](spark, SMALL))
    best = _plan(queries()["best_action"](spark, SMALL))
    assert best.count("Exchange") <= feats.count("Exchange")
    assert "Generate" not in best and "Window" not in best


def test_bucketed_delinquency_has_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries()["bucketed_delinquency"](spark, SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_delinquency_plan_summary(spark):
    s = plan_summary(queries()["loan_delinquency"](spark, SMALL), executed=True)
    assert s["python_udfs"] == 0 and s["nested_loop_joins"] == 0 and s["sort_aggregates"] == 0
    assert s["windows"] == 0 and s["hash_aggregates"] >= 2      # partial + final
    assert s["shuffles"] <= 2                                   # payments partial agg, loans side


def test_balance_needs_loans_only(spark):
    s = plan_summary(queries()["outstanding_balance"](spark, SMALL), executed=True)
    assert s["shuffles"] == 0
    assert "customer.parquet" not in _plan(queries()["outstanding_balance"](spark, SMALL))


def test_nothing_is_left_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    for name in ("loan_delinquency_sql", "bucketed_delinquency"):
        assert queries()[name](spark, SMALL).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
