"""Physical plans: no nested-loop joins, no row-at-a-time Python, pruned scans."""

import re
from pathlib import Path

import pytest

from quadrivium import workloads

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


def plan(spark, name):
    return workloads.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["vector_search", "course_matches", "retrieve_context", "min_similarity", "template_expand", "feedback_ingest", "model_gate"]
)
def test_no_nested_loops(spark, name):
    text = plan(spark, name)
    assert not any(x in text for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))


def test_scans_are_pruned(spark):
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan(spark, "bias_report")
    assert "ReadSchema: struct<conv_id:bigint>" in plan(spark, "distinct_crns")
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(event_type,error\)", plan(spark, "drift_trend"))


def test_position_shuffles_rows_once(spark):
    text = plan(spark, "order_split").split("BroadcastExchange")[0]
    assert text.count("Exchange hashpartitioning") == 1
