"""Plan shapes: what a 1000x larger input must not run into."""

import re

import pytest

from holecard.plans import oracle, queries

from conftest import SMOKE_DIR

QUERIES = queries.QUERIES
# no per-key shuffle at all: only the round-robin spread of a one-row-group input
ROW_LOCAL = ["line_candidates", "token_candidates", "lex_failures", "module_catalogue",
             "node_property_filter", "corpus_scan_filter"]


def _plan(spark, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_local_queries_do_not_shuffle_by_key(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan), plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "perplexity")
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp\w*,user_id:bigint,value:double>", plan)
    plan = _plan(spark, "pass_at_k")
    assert "props" not in plan and "n_chars" not in plan
