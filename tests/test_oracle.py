"""Every registered query equals its DuckDB oracle on the smallest tables
(tools/check_oracle.py runs the same comparison at any scale)."""

import pytest

from conftest import SF_SMALL

FAST = [
    "u2_normalize_url", "f1_page_text", "f2_main_content", "x5_tokens", "l1_region", "p6_keyword_match",
    "s3_hits", "s2_parse_responses", "s6_resolve", "d3_title_dedup", "j3_merge_edges", "k2_markdown", "q1_triage", "c1_leader",
]


@pytest.fixture(scope="module")
def con():
    from tools.check_oracle import duck

    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    from newsfold.plans import catalog as E
    from tools.check_oracle import compare

    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert res["status"] == "ok", res


def test_every_query_has_an_oracle():
    from newsfold.plans import catalog

    assert set(catalog.queries()) == set(catalog.oracle_sql())
