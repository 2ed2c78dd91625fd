"""Snapshots by bucket: the same resolved pages from a part of the files."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from newsfold.operators import hits as HT
from newsfold.operators.pages import page_base
from newsfold.operators.resolve import resolve_hits
from newsfold.sources import snapshot as SN
from newsfold.sources import tables
from newsfold.sources.tasks import PROSE_CONFIG


def resolved(hits, pages):
    rows = resolve_hits(hits, pages, PROSE_CONFIG.run_ts, hit_bound=PROSE_CONFIG.hit_bound, blocked_host_tokens=PROSE_CONFIG.blocked_host_tokens)
    return sorted(map(tuple, rows.collect()))


def test_same_rows_from_the_buckets_of_the_hits(spark, tmp_path):
    pages = tables.pages(spark, SF_SMALL)
    # copies of every page under its URL: one page per URL is written, the one that resolution picks
    crawl = pages.unionByName(pages.withColumns({"page_id": F.col("page_id") + 10_000, "html": F.lit("<p>a later copy</p>")}))
    path = str(tmp_path / "snapshot")
    SN.write_snapshot(crawl, path, buckets=64)
    hits = HT.search_hits(page_base(pages, with_main=False), HT.query_dimension(spark, PROSE_CONFIG), PROSE_CONFIG).checkpoint()
    few = hits.filter("task_name = 'prose_en' AND query_idx = 0")
    stored = SN.read_snapshot(spark, path, few)
    every = spark.read.parquet(f"{path}/pages")
    urls = few.select("normalized_url").distinct().count()
    files = {r[0] for r in stored.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(files) <= urls and len(files) < len(every.inputFiles()) / 2
    assert "PartitionFilters: [" + SN.BUCKET in stored._jdf.queryExecution().toString()
    assert resolved(few, stored) == resolved(few, crawl) != []
    assert resolved(hits, SN.read_snapshot(spark, path, hits)) == resolved(hits, pages)
    assert every.count() == every.select("normalized_url").distinct().count()


def test_no_hit_reads_no_page(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    SN.write_snapshot(tables.pages(spark, SF_SMALL), path, buckets=4)
    none = SN.read_snapshot(spark, path, spark.createDataFrame([("",)], "normalized_url string"))
    assert none.count() == 0 and set(none.columns) == {"page_id", "url", "html"}
