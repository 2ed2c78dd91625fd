"""
plan, partial top-k before the shuffle, query matching without a join."""

import pytest

from conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# corpus-cluster queries share their operators with q1_triage and c2/c1 and
# build eagerly (label rounds run while the DataFrame is constructed); one of
# each shape is enough for the plan checks
SAME_SHAPE = {"c8_cluster_table", "d4_representative", "d5_sources", "d6_cluster_tokens", "d7_cluster_signature",
              "d8_stage_counts", "t2_cluster_order", "t3_cap", "w2_cluster_id", "k2_markdown", "c1_grown", "c1_grown_excerpts"}


@pytest.fixture(scope="module")
def plans(spark):
    from newsfold.plans import catalog as E

    return {name: plan_of(fn(spark, SF_SMALL)) for name, fn in E.queries().items() if name not in SAME_SHAPE}


def test_no_cartesian_or_python_udf(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert not any(node in plan for node in PYTHON_NODES), name
        assert "InPandas" not in plan and "InArrow" not in plan, name


def test_topk_is_partial_before_shuffle(plans):
    for name in ("s3_hits", "t1_topk", "k1_json"):
        assert "WindowGroupLimit" in plans[name], name


def test_query_matching_needs_no_join(plans):
    for name, plan in plans.items():
        assert "BroadcastNestedLoopJoin" not in plan, name
    assert "Generate" in plans["p6_keyword_match"]


def test_canonical_url_is_worked_out_once(spark):
    from newsfold.plans import catalog

    plan = catalog.queries()["s3_hits"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("uddg") == 1 and plan.count("Relation") == 1


def test_many_phrases_take_one_scan_and_large_top_k_is_exact(spark):
    from newsfold.operators import hits as HT
    from newsfold.operators.pages import page_base
    from newsfold.sources import tables
    from newsfold.sources.tasks import PROSE_CONFIG, Query, Task, TaskConfig

    task = PROSE_CONFIG.tasks[0]
    many = Query("many", ((tuple(f"absent phrase {i}" for i in range(30_000)), ("the",)),))
    cfg = TaskConfig((Task("t", (*task.queries, many), top_k=2000),))
    base = page_base(tables.pages(spark, SF_SMALL), with_main=False)
    hits = HT.search_hits(base, HT.query_dimension(spark, cfg), cfg)
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    kept = hits.groupBy("query_idx").count().collect()
    all_ = HT.first_per_url(HT.keyword_hits(base, cfg, ()).select("task_name", "query_idx", "normalized_url", "src_pos")).groupBy("query_idx").count().collect()
    assert sorted(map(tuple, kept)) == sorted(map(tuple, all_)) and kept


def test_dedup_elects_without_content(spark):
    from newsfold.operators.dedup import _title_winners, _url_winners
    from newsfold.operators.pages import pages_as_resolved
    from newsfold.sources import tables

    plan = plan_of(_title_winners(_url_winners(pages_as_resolved(tables.pages(spark, SF_SMALL))), "strict"))
    for line in plan.splitlines():
        if "Aggregate" in line and "max_by" in line.lower():
            assert " content#" not in line and "html#" not in line
