"""Hits in order of relevance (inventory S3, T1, W1): an inverted index with BM25 scores.

A search provider returns its results best first.  Here the pages that satisfy
a query's formula (P6) are ranked by the BM25 score of the query's words
(k1 = 1.2, b = 0.75), ties by page id, in place of the page id alone.

The index is a table partitioned by the hash of the term.  A term's postings
(page, occurrences, length of the page) stand in blocks, one per range of page
ids, so a term that every page has is many rows of bounded size, built and read by
many tasks.  A written index answers queries from the partitions of their terms
alone.  Scores are whole numbers (weights and term parts in millionths), so that
sums do not depend on the order of the rows.

Only keys and scores take part in the ranking; titles and snippets are
fetched for the ranked rows, whose number the configuration bounds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import ensure_checkpoint_dir
from ..sources.tasks import TaskConfig
from . import hits as HT
from .pages import page_base, search_snippet
from .resolve import sized_broadcast

TERM_RE = r"[\p{L}\p{N}]+"
K1, B = 1.2, 0.75
MILLION = 1_000_000
#: Hash partitions of a written index.
BUCKETS = 256
#: Page ids of a block of postings.
BLOCK_PAGES = 4096

QUERY = ["task_name", "query_idx"]


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


class InvertedIndex:
    """blocks: bucket, term, block, postings (array of page_id, tf, n); stats: one row with the pages that have terms and their number of terms."""

    def __init__(self, blocks: DataFrame, stats: DataFrame) -> None:
        self.blocks, self.stats = blocks, stats

    @classmethod
    def build(cls, pages: DataFrame, text: Column, block_pages: int = BLOCK_PAGES) -> "InvertedIndex":
        """pages: page_id and the columns of text (lower-cased by the caller)."""
        ensure_checkpoint_dir(pages.sparkSession)
        terms = pages.select("page_id", F.regexp_extract_all(text, F.lit(TERM_RE), F.lit(0)).alias("terms"))
        rows = terms.select("page_id", F.size("terms").alias("n"), F.explode("terms").alias("term"))
        postings = rows.groupBy("page_id", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
        block = F.floor(F.col("page_id") / F.lit(block_pages)).alias("block")
        blocks = postings.groupBy(_bucket(F.col("term")).alias("bucket"), "term", block).agg(
            F.array_sort(F.collect_list(F.struct("page_id", "tf", "n"))).alias("postings")
        )
        blocks = blocks.checkpoint()  # the texts are read once
        sized = blocks.select(F.explode("postings").alias("p")).select("p.page_id", "p.n").distinct()
        return cls(blocks, sized.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")))

    def write(self, path: str) -> None:
        self.blocks.repartition("bucket", "block").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/blocks")
        self.stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> "InvertedIndex":
        return cls(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/stats"))

    def postings(self, terms: list[str]) -> DataFrame:
        """term, page_id, tf, n of some terms: literal conditions on bucket and term, which prune partitions and row groups."""
        spark = self.blocks.sparkSession
        buckets = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "term string").select(_bucket(F.col("term"))).distinct().collect()]
        held = self.blocks.filter(F.col("bucket").isin(buckets) & F.col("term").isin(terms))
        return held.select("term", F.explode("postings").alias("p")).select("term", "p.*")

    def scores(self, asked: list[tuple[str, int, str]]) -> DataFrame:
        """asked: (task_name, query_idx, term), the configuration.  Gives task_name, query_idx, page_id, score."""
        spark = self.blocks.sparkSession
        queries = spark.createDataFrame(asked, "task_name string, query_idx int, term string")
        if not asked:
            return queries.select(*QUERY, F.lit(0).cast("long").alias("page_id"), F.lit(0).cast("long").alias("score"))
        found = self.postings(sorted({t for *_, t in asked}))
        df = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))  # a row per term asked for
        pages, terms = self.stats.select("pages", "terms").first()
        mean = terms / pages if pages else 1.0
        idf = F.floor(F.lit(float(MILLION)) * F.ln(F.lit(1.0) + (F.lit(pages) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5))))
        weighted = df.select("term", idf.alias("idf"))
        part = F.floor(F.lit(float(MILLION)) * (F.col("tf") * F.lit(K1 + 1)) / (F.col("tf") + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * (F.col("n") / F.lit(mean)))))
        rows = found.join(F.broadcast(weighted), "term").join(F.broadcast(queries), "term")
        return rows.groupBy(*QUERY, "page_id").agg(F.sum(F.col("idf") * part).alias("score"))


def query_terms(cfg: TaskConfig) -> list[tuple[str, int, str]]:
    """The distinct words of each query's phrases."""
    word = re.compile(r"[^\W_]+")
    out = []
    for task in cfg.tasks:
        for i, q in enumerate(task.queries):
            phrases = (p for alternative in q.alternatives for clause in alternative for p in clause)
            out += [(task.name, i, w) for w in sorted({w for p in phrases for w in word.findall(p.lower())})]
    return out


def search_text() -> Column:
    """The text that P6 matches."""
    return F.lower(F.concat_ws(" ", "page_title", "body_text"))


def page_index(base: DataFrame) -> InvertedIndex:
    return InvertedIndex.build(base, search_text())


def ranked_hits(pages: DataFrame, qdim: DataFrame, cfg: TaskConfig, failures: DataFrame | None = None, index: InvertedIndex | None = None, page_dates: bool = False) -> DataFrame:
    """The hits of ``hits.search_hits``, ranked by score; adds ``score``.

    A fallback provider returns its top_k best of the last month before the filters, the primary one its best valid ones
    (S4, S5).  Of the pages of one URL the best one counts (D1).  ``pages``: page_id, url, html.  ``index``: an index of the same pages, written earlier."""
    base = page_base(pages, with_main=False, with_dates=page_dates)
    index = page_index(base) if index is None else index
    failures = HT.configured_failures(qdim) if failures is None else failures
    found = HT.keyword_hits(base, cfg, cfg.blocked_host_tokens)
    narrow = found.select(*QUERY, "src_pos", "normalized_url", "valid", "top_k", *[c for c in ("published",) if c in found.columns])
    scores = index.scores(query_terms(cfg)).withColumnRenamed("page_id", "src_pos")
    failed = F.broadcast(failures.select(*QUERY).distinct().withColumn("failed", F.lit(True)))
    scored = narrow.join(scores, [*QUERY, "src_pos"], "left").join(failed, QUERY, "left")
    scored = scored.withColumns({"score": F.coalesce("score", F.lit(0)), "failed": F.coalesce("failed", F.lit(False))})
    if "published" in narrow.columns:
        scored = scored.filter(~F.col("failed") | HT.published_since("published", cfg.run_ts)).drop("published")
    best = [F.desc("score"), F.asc("src_pos")]
    within = F.when(~F.col("failed"), F.struct("normalized_url", "valid"))  # as in hits.provider_hits, by score
    placed = scored.withColumn("place", F.row_number().over(Window.partitionBy(*QUERY, within).orderBy(*best))).filter(F.col("place") <= F.lit(cfg.max_top_k))
    valid = placed.filter((F.col("place") <= F.when(F.col("failed"), F.col("top_k")).otherwise(1)) & F.col("valid"))
    first = valid.groupBy(*QUERY, "failed", "top_k", "normalized_url").agg(F.min(F.struct((-F.col("score")).alias("minus"), "src_pos")).alias("b"))
    first = first.select(*QUERY, "failed", "top_k", "normalized_url", (-F.col("b.minus")).alias("score"), F.col("b.src_pos").alias("src_pos"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(*QUERY).orderBy(*best)))
    ranked = HT.with_arrival_seq(ranked.filter((F.col("rank") <= F.lit(cfg.max_top_k)) & (F.col("rank") <= F.col("top_k"))))
    ranked = ranked.checkpoint()
    # titles and snippets of the ranked pages only
    shown = page_base(pages.join(sized_broadcast(ranked.select(F.col("src_pos").alias("page_id")).distinct(), cfg.hit_bound), "page_id", "left_semi"), with_main=False)
    shown = shown.select(F.col("page_id").alias("src_pos"), F.col("page_title").alias("title"), "url", "domain", search_snippet("body_text").alias("snippet"))
    caps = qdim.select(*QUERY, "query_text", "final_event_cap", "max_content_chars")
    full = shown.join(sized_broadcast(ranked, cfg.hit_bound), "src_pos").join(F.broadcast(caps), QUERY)
    fails = F.col("failed")
    return full.select(
        F.lit(cfg.run_id).alias("run_id"),
        *QUERY,
        F.when(fails, F.lit("fallback")).otherwise(F.lit("primary")).alias("provider"),
        F.when(fails, X.region("query_text")).otherwise(F.lit("")).alias("region"),
        "rank",
        "score",
        "title",
        "url",
        "normalized_url",
        "domain",
        "snippet",
        "arrival_seq",
        "src_pos",
        "top_k",
        "final_event_cap",
        "max_content_chars",
    )
