"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL
from tests.harness import compare

ORACLE = oracle_sql()
ROWS_ONLY = sorted(set(queries()) - set(ORACLE))
SLOW = {"rf_scores", "feature_importance", "run_metrics"}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "most_recent_days_late" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SMALL, queries()[name], ORACLE[name])
    assert r["ok"], r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.count() > 0
