"""Plans: no cross joins, no Python workers, no unordered single-task windows over data."""

import re

import pytest

import __spark_entry__ as entry
from lotwise.plans import views
from lotwise.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = sorted(n for n in QUERIES if not n.endswith("_stream"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in p, bad
    # A nested loop may only carry a constant-size side; none of the queries needs one.
    assert "BroadcastNestedLoopJoin" not in p
    # Single-task windows are allowed only behind a limit.
    for m in re.finditer(r"Exchange SinglePartition", p):
        tail = p[m.start():m.start() + 1500]
        assert re.search(r"partial_|Limit|TakeOrdered", tail), tail[:400]


def test_pushdown(spark):
    p = entry.queries()["open_deadlines"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate" in p


def test_rank_filters_reach_the_tasks(spark):
    for name in ("latest_per_key", "stratified_sample", "score_trace_top5", "merge_most_complete"):
        assert "WindowGroupLimit" in plan(entry.queries()[name](spark, SF)), name


def test_scope_comes_before_pairs(spark):
    """Without broadcasts: parties meet the notices before they are aggregated, on one partitioning by notice."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        p = plan(views.outcomes(spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_returnflag", p)) == 1
    assert len(re.findall("Exchange hashpartitioning", p)) <= 5
    top = p.index("Window [")
    assert p.index("HashAggregate", top) < p.index("SortMergeJoin [notice_id", top)
    assert "Exchange" not in p[top:p.index("SortMergeJoin [notice_id", top)]
