"""Search hits (inventory S3, S4, S5, P1, P3, P4, P6, D1, W1, T1, O1).

Plan shape:

* P6 matches every page against the query dimension without a join: the
  query dimension is configuration known on the driver, so it is compiled
  into one literal array of query structs and each page keeps the queries it
  satisfies (``filter`` + ``explode`` in the scan stage; no shuffle, no
  pages-by-queries product).  The literals hold ``MAX_LITERAL_PHRASES`` phrases
  each; their results are concatenated, so any number of phrases takes one scan.
* With more than ``DICTIONARY_FROM`` phrases the query dimension becomes a
  phrase dictionary instead (``phrases``), so that the cost follows the texts.
* P1/P3/P4 are conditions on the same array.
* D1 (first sighting per query and canonical URL) is an aggregation with a
  map-side partial ``min(struct(src_pos, ...))``, so a URL repeated by many
  pages never concentrates in one task.
* W1/T1 rank kept hits per query; ``rank <= max_top_k`` lets Catalyst insert
  a partial WindowGroupLimit before the shuffle, so a query matching a third
  of all pages still ships only ``top_k`` rows per map partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..session import ensure_checkpoint_dir
from ..sources.tasks import TaskConfig, queries_df, tasks_df
from .pages import search_snippet
from .phrases import phrase_matches

SEQ_STRIDE = 1 << 32
# phrases of one literal array
MAX_LITERAL_PHRASES = 20_000
# phrases from which a dictionary finds the matches
DICTIONARY_FROM = 1_000
QUERY_STRUCT = "struct<task_name:string,query_idx:int,alternatives:array<array<array<string>>>,exclude_hosts:array<string>,top_k:int>"


def query_matches(searchable: Column, alternatives: Column) -> Column:
    """OR over alternatives of AND over clauses of OR over phrases, each
    phrase a substring of the lowercased searchable text."""
    return F.exists(
        alternatives,
        lambda alt: F.forall(
            alt, lambda clause: F.exists(clause, lambda ph: F.instr(searchable, ph) > 0)
        ),
    )


def query_dimension(spark, cfg: TaskConfig) -> DataFrame:
    """queries joined with their task caps (both configuration-sized)."""
    q = queries_df(spark, cfg)
    t = tasks_df(spark, cfg)
    return q.join(F.broadcast(t), "task_name")


def _query_struct(task, idx: int, q) -> Column:
    alts = F.array(
        *[F.array(*[F.array(*[F.lit(p.lower()) for p in clause]) for clause in alt]) for alt in q.alternatives]
    )
    excl = F.array(*[F.lit(h.lower()) for h in q.exclude_hosts])
    return F.struct(
        F.lit(task.name).alias("task_name"),
        F.lit(idx).alias("query_idx"),
        alts.alias("alternatives"),
        excl.alias("exclude_hosts"),
        F.lit(task.top_k).alias("top_k"),
    ).cast(QUERY_STRUCT)


def query_chunks(cfg: TaskConfig, max_phrases: int = MAX_LITERAL_PHRASES) -> list[Column]:
    """The query dimension as literal arrays of query structs, each holding at
    most ``max_phrases`` phrases."""
    chunks, current, n = [], [], 0
    for t in cfg.tasks:
        for i, q in enumerate(t.queries):
            size = sum(len(c) for alt in q.alternatives for c in alt)
            if current and n + size > max_phrases:
                chunks.append(current)
                current, n = [], 0
            current.append(_query_struct(t, i, q))
            n += size
    if current:
        chunks.append(current)
    return [F.array(*c) for c in chunks]


def matching_queries(searchable: Column, queries: Column) -> Column:
    """The queries (structs) whose formula the lowercased text satisfies."""
    return F.filter(queries, lambda q: query_matches(searchable, q["alternatives"]))


def formula_rows(spark, cfg: TaskConfig) -> DataFrame:
    """task_name, query_idx, alt, clause, phrase of the configuration."""
    rows = [
        (t.name, i, a, c, phrase.lower())
        for t in cfg.tasks
        for i, q in enumerate(t.queries)
        for a, alternative in enumerate(q.alternatives)
        for c, clause in enumerate(alternative)
        for phrase in clause
    ]
    return spark.createDataFrame(rows, "task_name string, query_idx int, alt int, clause int, phrase string")


def _dictionary_hits(searchable: DataFrame, cfg: TaskConfig, blocked_host_tokens) -> DataFrame:
    """The rows that the literal arrays of ``keyword_hits`` would explode to."""
    spark = searchable.sparkSession
    ensure_checkpoint_dir(spark)
    texts = searchable.withColumnsRenamed({"page_id": "id", "_search": "text"})
    shown = tuple(c for c in searchable.columns if c not in ("page_id", "_search"))
    pairs = phrase_matches(texts, formula_rows(spark, cfg), ["task_name", "query_idx"], shown).withColumnRenamed("id", "page_id")
    queries = query_dimension(spark, cfg).select("task_name", "query_idx", "exclude_hosts", "top_k")
    hits = pairs.join(F.broadcast(queries), ["task_name", "query_idx"])
    if blocked_host_tokens is not None:
        hits = hits.filter(~U.excluded_by_site(F.col("domain"), F.col("exclude_hosts")))
    return hits


def _placed(hits: DataFrame, blocked_host_tokens) -> DataFrame:
    hits = hits.withColumn("src_pos", F.col("page_id"))
    if blocked_host_tokens is None:
        return hits
    passes = (F.col("title") != "") & (F.col("normalized_url") != "") & U.host_allowed(F.col("domain"), blocked_host_tokens)
    return hits.withColumn("valid", passes).drop("exclude_hosts")


def keyword_hits(base: DataFrame, cfg: TaskConfig, blocked_host_tokens=None) -> DataFrame:
    """P6 over page_base rows: one row per (task, query, matching page) with
    the page's search-result fields and the query's exclusions and top_k.
    ``src_pos`` orders results (page_id).

    With ``blocked_host_tokens``, P4 is part of the match (a provider does not
    return excluded hosts) and ``valid`` says whether the hit passes P1 and
    P3.  P4 stands inside the exploded array: as a filter it would be pushed
    below it with a copy of the canonical URL's expression."""
    searchable = base.select(
        "page_id",
        F.col("page_title").alias("title"),
        "url",
        "normalized_url",
        "domain",
        search_snippet("body_text").alias("snippet"),
        F.lower(F.concat_ws(" ", "page_title", "body_text")).alias("_search"),
        *[c for c in ("published",) if c in base.columns],
    )
    if sum(len(c) for t in cfg.tasks for q in t.queries for alt in q.alternatives for c in alt) > DICTIONARY_FROM:
        return _placed(_dictionary_hits(searchable, cfg, blocked_host_tokens), blocked_host_tokens)
    chunks = query_chunks(cfg) or [F.array().cast(f"array<{QUERY_STRUCT}>")]
    found = F.concat(*[matching_queries(F.col("_search"), chunk) for chunk in chunks])
    if blocked_host_tokens is not None:
        found = F.filter(found, lambda q: ~U.excluded_by_site(F.col("domain"), q["exclude_hosts"]))
    hits = searchable.select("*", F.explode(found).alias("_q"))
    return _placed(hits.select("*", "_q.*").drop("_q", "_search", "alternatives"), blocked_host_tokens)


def published_since(ts_col: str, run_ts: str, months: int = 1) -> Column:
    return F.col(ts_col) >= F.expr(f"TIMESTAMP_NTZ '{run_ts[:19]}' - INTERVAL {int(months)} MONTH")


def recent(df: DataFrame, ts_col: str, run_ts: str, months: int = 1) -> DataFrame:
    """P5: rows of the last months before the run."""
    return df.filter(published_since(ts_col, run_ts, months))


def provider_hits(hits: DataFrame, failures: DataFrame, cfg: TaskConfig) -> DataFrame:
    """The valid hits of each query, by its provider.

    The primary provider's results pass P1/P3 first and are counted after;
    the fallback provider, which answers the queries in ``failures``
    (task_name, query_idx; configuration-sized), returns ``top_k`` results of the last
    month, before P1/P3, so that it can leave fewer.  Both cuts are one
    window with a map-side limit: per query for the fallback, per query and URL otherwise
    (its first row is D1's)."""
    failed = F.broadcast(failures.select("task_name", "query_idx").distinct().withColumn("failed", F.lit(True)))
    hits = hits.join(failed, ["task_name", "query_idx"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
    if "published" in hits.columns:
        hits = hits.filter(~F.col("failed") | published_since("published", cfg.run_ts)).drop("published")
    within = F.when(~F.col("failed"), F.struct("normalized_url", "valid"))
    place = F.row_number().over(Window.partitionBy("task_name", "query_idx", within).orderBy("src_pos"))
    placed = hits.withColumn("_place", place).filter(F.col("_place") <= F.lit(cfg.max_top_k))
    return placed.filter((F.col("_place") <= F.when(F.col("failed"), F.col("top_k")).otherwise(1)) & F.col("valid")).drop("_place", "valid")


def valid_hits(hits: DataFrame, blocked_host_tokens) -> DataFrame:
    """P1 + P3 + P4."""
    return hits.filter(
        (F.col("title") != "")
        & (F.col("normalized_url") != "")
        & U.host_allowed(F.col("domain"), blocked_host_tokens)
        & ~U.excluded_by_site(F.col("domain"), F.col("exclude_hosts"))
    )


def first_per_url(hits: DataFrame, keys=("task_name", "query_idx")) -> DataFrame:
    """Per query and canonical URL keep the first sighting (min src_pos)."""
    carried = [c for c in hits.columns if c not in (*keys, "normalized_url", "src_pos")]
    agg = hits.groupBy(*keys, "normalized_url").agg(
        F.min(F.struct("src_pos", *carried)).alias("_first")
    )
    return agg.select(*keys, "normalized_url", "_first.*")


def rank_top_k(hits: DataFrame, max_top_k: int, keys=("task_name", "query_idx")) -> DataFrame:
    """W1 + T1: rank 1..n by src_pos per query, keep rank <= top_k."""
    w = Window.partitionBy(*keys).orderBy("src_pos")
    ranked = hits.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= F.lit(max_top_k)).filter(F.col("rank") <= F.col("top_k"))


def with_arrival_seq(hits: DataFrame) -> DataFrame:
    """Submission order of hits: (query_idx, rank) as one long."""
    return hits.withColumn(
        "arrival_seq", F.col("query_idx").cast("long") * F.lit(SEQ_STRIDE) + F.col("rank").cast("long")
    )


def configured_failures(qdim: DataFrame) -> DataFrame:
    """Queries marked ``primary_fails`` in the configuration."""
    return qdim.filter("primary_fails").select("task_name", "query_idx")


def search_hits(base: DataFrame, qdim: DataFrame, cfg: TaskConfig, failures: DataFrame | None = None) -> DataFrame:
    """Ranked hits of all queries of all tasks, one table.

    ``failures`` (task_name, query_idx): queries whose primary provider raised,
    by default those marked in the configuration; the fallback provider
    answers them (``provider = 'fallback'``, the L1 region of the query text).
    Both providers are served by one scan and one match."""
    failures = configured_failures(qdim) if failures is None else failures
    hits = provider_hits(keyword_hits(base, cfg, cfg.blocked_host_tokens), failures, cfg)
    hits = first_per_url(hits)
    hits = rank_top_k(hits, cfg.max_top_k)
    hits = with_arrival_seq(hits).drop("top_k")
    caps = qdim.select(
        "task_name", "query_idx", "query_text", "top_k", "final_event_cap", "max_content_chars"
    )
    hits = hits.join(F.broadcast(caps), ["task_name", "query_idx"])
    fails = F.col("failed")
    return hits.select(
        F.lit(cfg.run_id).alias("run_id"),
        "task_name",
        "query_idx",
        F.when(fails, F.lit("fallback")).otherwise(F.lit("primary")).alias("provider"),
        F.when(fails, X.region("query_text")).otherwise(F.lit("")).alias("region"),
        "rank",
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
