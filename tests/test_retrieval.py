"""Ranked hits: the inverted index, its blocks and its scores."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from newsfold.operators import hits as HT
from newsfold.operators import retrieval as RT
from newsfold.plans.triage import run_triage
from newsfold.sources import tables
from newsfold.sources.tasks import PROSE_CONFIG, Query, Task, TaskConfig

TEXTS = {i: " ".join(["hot"] * (1 + i % 5) + [f"w{i % 7}", f"own{i}"] * (i % 4)) for i in range(300)} | {400: "", 401: "...", 402: "Été été über_x 12"}


def by_hand(asked):
    terms = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in TEXTS.items()}
    terms = {i: t for i, t in terms.items() if t}
    mean = sum(map(len, terms.values())) / len(terms)
    df = Counter(w for t in terms.values() for w in set(t))
    out = {}
    for task, query, word in asked:
        idf = math.floor(1e6 * math.log(1 + (len(terms) - df[word] + 0.5) / (df[word] + 0.5)))
        for i, t in terms.items():
            if word in t:
                tf = t.count(word)
                part = math.floor(1e6 * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * (len(t) / mean))))
                out[task, query, i] = out.get((task, query, i), 0) + idf * part
    return out


@pytest.fixture(scope="module")
def index(spark):
    pages = spark.createDataFrame(list(TEXTS.items()), "page_id long, text string")
    return RT.InvertedIndex.build(pages, F.lower("text"), block_pages=16)


ASKED = [("a", 0, "hot"), ("a", 0, "w3"), ("a", 1, "own9"), ("b", 0, "hot"), ("b", 0, "été"), ("b", 0, "nowhere"), ("b", 1, "12")]


def test_scores(index):
    got = {(r.task_name, r.query_idx, r.page_id): r.score for r in index.scores(ASKED).collect()}
    assert got == by_hand(ASKED)


def test_a_term_of_every_page_is_many_bounded_blocks(index):
    hot = index.blocks.filter("term = 'hot'").select(F.size("postings").alias("n")).collect()
    assert len(hot) == 19 and max(r.n for r in hot) <= 16 and sum(r.n for r in hot) == 300


def test_written_index_reads_the_partitions_of_its_terms(spark, index, tmp_path):
    index.write(str(tmp_path / "index"))
    stored = RT.InvertedIndex.read(spark, str(tmp_path / "index"))
    got = {(r.task_name, r.query_idx, r.page_id): r.score for r in stored.scores(ASKED).collect()}
    assert got == by_hand(ASKED)
    found = stored.postings(["own9", "12"])
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan
    assert len(found.inputFiles()) <= len(stored.blocks.inputFiles())
    assert {r.page_id for r in found.collect()} == {9, 402}


def test_best_first_and_ties_by_page(spark):
    html = "<html><head><title>T{0}</title></head><body><p>{1}</p></body></html>"
    pages = [(i, f"http://h{i}.example.com/p", html.format(i, " ".join(["alpha"] * tf + ["filler"] * (9 - tf)))) for i, tf in enumerate([1, 5, 2, 5, 0, 9])]
    pages += [(10, "http://h1.example.com/p", html.format(10, "alpha " * 9))]  # the URL of page 1, with a better text
    cfg = TaskConfig((Task("t", (Query("alpha", ((("alpha",),),)),), top_k=4),), run_id="r", run_ts="2026-01-01T00:00:00+00:00")
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = RT.ranked_hits(table, HT.query_dimension(spark, cfg), cfg).orderBy("rank").collect()
    assert [r.src_pos for r in got] == [5, 10, 3, 2]
    assert [r["rank"] for r in got] == [1, 2, 3, 4] and got[0].score == got[1].score > got[2].score


def test_run_by_score(spark):
    r = run_triage(spark, tables.pages(spark, SF_SMALL), PROSE_CONFIG, hit_order="score", cluster_mode="leader")
    by_rank = r.hits.groupBy("task_name", "query_idx").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("last"))
    assert all(x.n == x["last"] for x in by_rank.collect()) and r.ranked.count() > 0
