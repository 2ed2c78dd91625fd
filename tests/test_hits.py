"""Query matching (P6) in one or several literal chunks gives the same hits."""

from pyspark.sql import functions as F

from newsfold.operators import hits as HT
from newsfold.operators.pages import page_base
from newsfold.sources import tables
from newsfold.sources.tasks import PROSE_CONFIG

from conftest import SF_SMALL


def test_chunked_matching_equals_single_pass(spark, monkeypatch):
    base = page_base(tables.pages(spark, SF_SMALL), with_main=False)
    one = sorted(tuple(r) for r in HT.keyword_hits(base, PROSE_CONFIG).select("task_name", "query_idx", "page_id").collect())
    monkeypatch.setattr(HT, "MAX_LITERAL_PHRASES", 2)
    chunks = HT.query_chunks(PROSE_CONFIG, max_phrases=2)
    assert len(chunks) > 1
    monkeypatch.setattr(HT, "query_chunks", lambda cfg, max_phrases=2: chunks)
    many = sorted(tuple(r) for r in HT.keyword_hits(base, PROSE_CONFIG).select("task_name", "query_idx", "page_id").collect())
    assert one == many and one


def test_boolean_formula(spark):
    q = PROSE_CONFIG.tasks[1].queries[0]  # ((que) (des)) OR ((und) (der))
    df = spark.createDataFrame([("que des",), ("und der",), ("que der",), ("",)], "t string")
    (queries,) = HT.query_chunks(type(PROSE_CONFIG)(tasks=(type(PROSE_CONFIG.tasks[1])("x", (q,)),)))
    got = [r[0] for r in df.select(F.size(HT.matching_queries(F.col("t"), queries))).collect()]
    assert got == [1, 1, 0, 0]


def _pages(spark, n):
    base = [(i, f"T{i}", f"https://h{i % 7}.example/{i % 9}", f"the and page {i}") for i in range(n)]
    from newsfold.functions.urls import with_canonical_url

    return with_canonical_url(spark.createDataFrame(base, "page_id long, page_title string, url string, body_text string"), "url")


def test_fallback_is_cut_before_the_filters(spark):
    from newsfold.sources.tasks import Query, Task, TaskConfig

    query = Query("q", ((("the",), ("and",)),))
    cfg = TaskConfig((Task("t", (query, query), top_k=10),), blocked_host_tokens=("h0", "h1"))
    base = _pages(spark, 60)
    failures = spark.createDataFrame([("t", 1)], "task_name string, query_idx int")
    hits = HT.search_hits(base, HT.query_dimension(spark, cfg), cfg, failures).collect()

    def expected(rows):
        seen, out = set(), []
        for i in rows:
            url = f"https://h{i % 7}.example/{i % 9}"
            if i % 7 > 1 and url not in seen:
                seen.add(url)
                out.append(i)
        return out[:10]

    got = lambda k: [r.src_pos for r in sorted(hits, key=lambda r: r["rank"]) if r.query_idx == k]
    assert got(0) == expected(range(60)) and len(got(0)) == 10
    assert got(1) == expected(range(10)) and len(got(1)) < 10
    assert {(r.query_idx, r.provider) for r in hits} == {(0, "primary"), (1, "fallback")}
    assert {bool(r.region) for r in hits if r.query_idx == 1} == {True}


def test_fallback_takes_the_last_month(spark):
    from newsfold.sources.tasks import Query, Task, TaskConfig

    query = Query("q", ((("the",),),))
    cfg = TaskConfig((Task("t", (query, query), top_k=50),), run_ts="2024-02-15T00:00:00+00:00")
    base = _pages(spark, 9).withColumn("published", F.expr("TIMESTAMP_NTZ '2024-02-14 00:00:00' - make_interval(0, 0, page_id)"))
    failures = spark.createDataFrame([("t", 1)], "task_name string, query_idx int")
    hits = HT.search_hits(base, HT.query_dimension(spark, cfg), cfg, failures).collect()
    assert sorted(r.src_pos for r in hits if r.query_idx == 0) == list(range(9))
    assert sorted(r.src_pos for r in hits if r.query_idx == 1) == [0, 1, 2, 3, 4]


def test_final_urls(spark):
    from newsfold.operators.resolve import resolve_hits

    rows = [(1, "https://a.example/x", "https://B.example/y/?utm_source=q"), (2, "https://a.example/spam", "https://spam-farm.example/"), (3, "https://a.example/bad", "mailto:x@y")]
    snapshot = spark.createDataFrame([(i, u, f, "<title>Page</title><p>body text</p>") for i, u, f in rows], "page_id long, url string, final_url string, html string")
    hits = spark.createDataFrame(
        [("r", "t", i, "Hit", u, "a.example", "snippet") for i, u, _ in rows] + [("r", "t", 4, "Hit", "https://a.example/gone", "a.example", "snippet")],
        "run_id string, task_name string, arrival_seq long, title string, normalized_url string, domain string, snippet string",
    )
    got = {r.arrival_seq: (r.url, r.domain, r.title, r.fetch_status) for r in resolve_hits(hits, snapshot, blocked_host_tokens=("spam-farm",)).collect()}
    assert got[1] == ("https://B.example/y", "b.example", "Page", "ok")
    assert got[2] == ("https://a.example/spam", "a.example", "Hit", "fallback:ValueError")
    assert got[3][2:] == ("Hit", "fallback:ValueError") and got[4][2:] == ("Hit", "fallback:HTTPError")
