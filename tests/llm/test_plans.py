"""The native operators run DataFrame functions only; nothing crosses or collects in the plans."""

import pytest

from arrears.llm.queries import ORACLE, QUERIES
from arrears.plans.inspect import physical_plan
from tests.conftest import SMALL

NATIVE = ("op3_chat_format", "op5_host_rules", "op6_license_scan", "op8_url_lists")


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 11)) and "pipeline" in QUERIES
    assert {n for n in QUERIES if n not in ORACLE} == {
        "op2_quality_classifier", "op4_toxicity", "op7_simhash", "op9_html_text", "pipeline"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = physical_plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    if name in NATIVE:
        for bad in ("Python", "Pandas", "ArrowEval"):
            assert bad not in plan


def test_texts_are_not_shuffled(spark):
    """Where the document texts stay: they are read, measured and dropped in the scan's own stage."""
    for name in ("op1_mix_sources", "op5_host_rules"):
        assert "documents.parquet" not in physical_plan(QUERIES[name](spark, SMALL))     # only narrow tables are joined
    assert "Exchange" not in physical_plan(QUERIES["op10_decontaminate"](spark, SMALL))
    assert "Exchange" not in physical_plan(QUERIES["op9_html_text"](spark, SMALL))
