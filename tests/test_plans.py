"""Physical-plan guards: properties every registered query must keep at scale."""

import pytest

from tests.helpers import SF_SMALL
from ledgerflow.registry import QUERIES

MODEL_BASED = {n for n in QUERIES if "gbt" in n or n.startswith("compare_models")}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_BASED))
def test_no_pair_explosion_and_no_row_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert op not in plan, f"{name} plans a {op}"


def test_top_k_limits_before_the_shuffle(spark):
    plan = QUERIES["profile_topk"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_filters_reach_the_scan(spark):
    from ledgerflow.registry import etl
    plan = _plan(etl(spark, SF_SMALL).olap)
    assert "PushedFilters: [IsNotNull(ID_COMPANY)" in plan
