"""Plan shape: no cartesian products or nested-loop joins; top-k stays a group limit."""

import pytest

from loomweave.plans.catalog import QUERIES

SF_SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["community_listing_hot", "related_posts", "budget_advice",
                                  "search_posts_relevance", "resolve_identifiers", "pii_findings",
                                  "forest_cap", "paged_run_audit"])
def test_no_cross_products(spark, name):
    plan = plan_of(spark, name)
    assert not any(op in plan for op in FORBIDDEN), name


@pytest.mark.parametrize("name", ["related_posts", "forest_cap"])
def test_top_k_is_a_group_limit(spark, name):
    assert "WindowGroupLimit" in plan_of(spark, name)


def test_listing_is_distributed_top_k(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "community_listing_hot")
