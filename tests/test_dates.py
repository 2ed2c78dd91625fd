"""Publication dates from HTML."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsfold.functions.dates import instant, published_at
from newsfold.operators import hits as HT
from newsfold.operators.pages import page_base
from newsfold.sources.tasks import Query, Task, TaskConfig

VALUES = {
    "2024-02-15": datetime(2024, 2, 15),
    "2024-02-15T10:30:00Z": datetime(2024, 2, 15, 10, 30),
    " 2024-02-15 10:30 ": datetime(2024, 2, 15, 10, 30),
    "2024-02-15T00:10:00.250-0300": datetime(2024, 2, 15, 3, 10),
    "2024-02-15T00:10:00,5+05:30": datetime(2024, 2, 14, 18, 40),
    "2024-12-31t23:59:59-00:30": datetime(2025, 1, 1, 0, 29, 59),
    "2024-02-30": None,
    "2024-02-15T25:00": None,
    "yesterday": None,
    "15.02.2024": None,
    "": None,
}


def test_instants(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES], "v string").select("v", instant(F.col("v")).alias("t")).collect()
    assert {r.v: r.t for r in rows} == VALUES


@pytest.mark.parametrize(
    "html, day",
    [
        ('<meta name="pubdate" content="2024-01-02"><time datetime="2024-03-03">', 2),
        ("<META CONTENT='2024-01-03' itemprop='datePublished'>", 3),
        ('<script type="application/ld+json">{"datePublished" : "2024-01-04T00:00:00Z"}</script>', 4),
        ("<p>x<time class=a datetime='2024-01-05'>then</time>", 5),
        ('<meta name="date" content="soon"><time datetime="2024-01-06">', 6),
        ('<meta name="datex" content="2024-01-07"><meta name="description" content="2024-01-08">', None),
        ("<p>2024-01-09</p>", None),
        (None, None),
    ],
)
def test_where_pages_name_their_date(spark, html, day):
    got = spark.createDataFrame([(html,)], "h string").select(published_at("h")).first()[0]
    assert got == (None if day is None else datetime(2024, 1, day))


def test_fallback_goes_by_the_dates_of_the_pages(spark):
    days = ["2024-02-01", "2023-12-01", "2024-01-16", "2024-01-14", None]
    rows = [(i, f"http://h{i}.example.com/", f"<title>T</title>{f'<time datetime={chr(34)}{d}{chr(34)}>' if d else ''}<p>alpha</p>") for i, d in enumerate(days)]
    query = Query("alpha", ((("alpha",),),), primary_fails=True)
    cfg = TaskConfig((Task("t", (query,), top_k=10),), run_id="r", run_ts="2024-02-15T00:00:00+00:00")
    base = page_base(spark.createDataFrame(rows, "page_id long, url string, html string"), with_main=False, with_dates=True)
    assert sorted(r.src_pos for r in HT.search_hits(base, HT.query_dimension(spark, cfg), cfg).collect()) == [0, 2]
