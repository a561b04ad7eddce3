"""Plan-shape regressions: the ordered passes keep one shuffle and one sort."""

import re

import pytest

from factlake.plans import registry
from tests.conftest import SF_SMALL

registry.load_all()
QUERIES = dict(registry.QUERIES)


def plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def count(p, pattern):
    return len(re.findall(pattern, p))


@pytest.mark.parametrize("name", ["restatement_event", "financials_current"])
def test_flagship_is_one_exchange_one_sort(spark, name):
    p = plan(spark, name)
    assert count(p, r"Exchange hashpartitioning") == 1
    assert count(p, r"(?<!Take)(?<!Merge)\bSort \[") == 1
    assert "SortAggregate" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scd2_chain_shares_one_sort(spark):
    p = plan(spark, "scd2_history")
    windows_part = p.split("Exchange hashpartitioning(cik")[0]
    assert count(windows_part, r"\bSort \[") == 1 and count(windows_part, r"\bWindow \[") == 3


@pytest.mark.parametrize("name", ["replay_diff", "request_plan", "company_profile", "merge_upsert"])
def test_no_pairwise_joins(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
