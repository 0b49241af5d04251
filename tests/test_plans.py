"""Plans: no cross joins, pruned scans, pushed filters."""

import re

import pytest

from foliant.plans.catalog import QUERIES

#: One-row sides only: a total and the place of one element.
ONE_ROW: set[str] = set()
#: These run jobs while the plan is made.
EAGER = {"sitting_bind", "sitting_findings", "sitting_health", "review_queue", "knn_top10", "neighbour_jaccard",
    "drift_gate", "batch_keys_400", "leakage_guard", "applied_embeddings"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    if name not in ONE_ROW:
        assert "BroadcastNestedLoopJoin" not in text


def test_scans_read_what_is_used(spark, sf):
    text = plan(QUERIES["total_reconcile"](spark, sf))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("l_extendedprice" in s and "l_shipdate" not in s for s in schemas)
    assert any("o_totalprice" in s and "o_orderdate" not in s for s in schemas)
    assert "text" not in str(re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["severity_rollup"](spark, sf))))


def test_filters_reach_the_scan(spark, sf):
    text = plan(QUERIES["or_semi_join"](spark, sf))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(c_acctbal,9900", text)


def test_aggregates_combine_before_the_exchange(spark, sf):
    text = plan(QUERIES["dup_first_wins"](spark, sf))
    assert "partial_min" in text and text.count("Exchange") == 1
