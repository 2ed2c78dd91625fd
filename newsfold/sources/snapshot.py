"""Page snapshots laid out for resolution (inventory S6, J1).

Resolving hits against a crawl that lies in the order of its arrival reads
every page's HTML to find a few.  A snapshot written here holds one page per
canonical URL (the smallest page_id, which resolution would pick), dealt into
buckets by the URL's hash and sorted by URL inside them, with a Bloom filter
of the URLs in every row group.  Hits, whose number the configuration bounds,
name the buckets that can hold their pages; the scan reads those alone.

Canonical URLs are worked out once, when the snapshot is written.  A URL that a
third of all pages have is one page of one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.urls import with_canonical_url

#: Buckets of a snapshot; at 100 TB a bucket of 16,384 holds 6 GB, in several files of MAX_FILE_ROWS rows.
BUCKETS = 1024
MAX_FILE_ROWS = 100_000
BUCKET = "url_bucket"


def _bucket(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def write_snapshot(pages: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """pages: page_id, url, html and any further columns.  Pages without a canonical URL are left out."""
    keyed = with_canonical_url(pages.select("page_id", X.normalize_ws("url").alias("url")), "url", domain_col=None).filter("normalized_url != ''")
    first = keyed.groupBy("normalized_url").agg(F.min("page_id").alias("page_id"))
    rows = pages.join(first, "page_id").withColumn(BUCKET, _bucket(F.col("normalized_url"), buckets))
    # a row per bucket count, so that a reader knows it
    pages.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")
    dealt = rows.repartition(BUCKET).sortWithinPartitions(BUCKET, "normalized_url")
    writer = dealt.write.mode("overwrite").partitionBy(BUCKET).option("maxRecordsPerFile", MAX_FILE_ROWS)
    writer.option("parquet.bloom.filter.enabled#normalized_url", "true").option("parquet.bloom.filter.expected.ndv#normalized_url", str(MAX_FILE_ROWS)).parquet(f"{path}/pages")


def read_snapshot(spark: SparkSession, path: str, urls: DataFrame) -> DataFrame:
    """The pages of the buckets that the canonical URLs in ``urls`` (normalized_url, of a bounded number) fall into."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    named = urls.filter("normalized_url != ''").select(_bucket(F.col("normalized_url"), buckets).alias("b")).distinct()
    wanted = sorted(r["b"] for r in named.collect())  # at most as many as there are buckets, or hits
    return spark.read.parquet(f"{path}/pages").filter(F.col(BUCKET).isin(wanted)).drop(BUCKET, "normalized_url")
