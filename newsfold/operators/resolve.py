"""Page resolution (inventory S6, J1, P7, F3, N1).

Each hit is resolved against a page snapshot (the crawl) by canonical URL; a
hit without a snapshot page keeps its own title and its cleaned snippet and
gets status ``fallback:HTTPError`` (what a failed fetch reports).

Plan shape at scale: hits are few (bounded by queries x top_k) and the snapshot
is the whole crawl.  The snapshot streams through a broadcast left-semi join
on the hit URLs, so only matching pages survive the scan; the expensive HTML
extraction (F1/F2) then runs on those rows only.  When several snapshot pages
share a canonical URL the smallest page_id wins.  The final hit-to-page join
is between two small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import html as H
from ..functions import scoring as R
from ..functions import text as X
from ..functions.urls import host_allowed, with_canonical_url
from .pages import resolved_columns

# Rows of a side we are willing to broadcast without measuring it first.
BROADCAST_ROW_LIMIT = 2_000_000


def sized_broadcast(df: DataFrame, bound: int | None = None, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its row count is known (or measured) to be
    at most ``limit``; otherwise leave the join strategy to the planner
    (shuffle join)."""
    n = bound if bound is not None else df.count()
    return F.broadcast(df) if n <= limit else df


def matching_pages(snapshot: DataFrame, urls: DataFrame) -> DataFrame:
    """normalized_url, page_id of the snapshot pages whose canonical URL is
    among ``urls``; the smallest page_id of each URL."""
    keyed = with_canonical_url(snapshot.select("page_id", X.normalize_ws("url").alias("url")), "url", domain_col=None)
    return keyed.join(urls, "normalized_url", "left_semi").groupBy("normalized_url").agg(F.min("page_id").alias("page_id"))


def snapshot_pages(snapshot: DataFrame, urls: DataFrame) -> DataFrame:
    """Snapshot pages whose canonical URL is among ``urls``; one page per URL
    (smallest page_id) with its title, readable text and final URL (that of
    ``final_url`` where the snapshot has the column, else the page's own)."""
    final = "final_url" if "final_url" in snapshot.columns else "url"
    keyed = with_canonical_url(
        snapshot.select("page_id", X.normalize_ws("url").alias("url"), X.normalize_ws(final).alias("_final"), "html"), "url", domain_col=None
    )
    matched = keyed.join(urls, "normalized_url", "left_semi")
    first = matched.groupBy("normalized_url").agg(F.min_by(F.struct("page_id", "html", "_final"), F.col("page_id")).alias("p"))
    clean = H.strip_dropped_elements(F.col("p.html"))
    df = first.select(
        "normalized_url",
        F.col("p.page_id").alias("page_id"),
        H.html_title(F.col("p.html")).alias("page_title"),
        F.col("p._final").alias("_final"),
        clean.alias("_clean"),
    )
    df = with_canonical_url(df, "_final", "final_url", "final_domain")
    df = df.withColumns(
        {
            "body_text": H.html_text("_clean"),
            "main_text": H.main_content("_clean"),
        }
    )
    return df.select(
        "normalized_url",
        "page_id",
        "page_title",
        "final_url",
        "final_domain",
        F.when(F.col("main_text") != "", F.col("main_text")).otherwise(F.col("body_text")).alias("readable_text"),
    )


def resolve_hits(
    hits: DataFrame,
    snapshot: DataFrame,
    run_ts: str = K.DEFAULT_RUN_TS,
    hit_bound: int | None = None,
    default_max_chars: int = K.DEFAULT_MAX_CONTENT_CHARS,
    blocked_host_tokens=(),
) -> DataFrame:
    """Resolved pages, one per hit.  A page whose final URL has no canonical
    form or a blocked host (P3) counts as a failed fetch, ``fallback:ValueError``;
    otherwise URL and domain are those of the final URL.

    ``hits`` needs run_id, task_name, arrival_seq, title, normalized_url,
    domain, snippet and optionally max_content_chars."""
    # hits are read twice (URL keys, final join) and are bounded by the
    # configuration; a reliable checkpoint computes them once
    hits = hits.checkpoint()
    urls = hits.select("normalized_url").distinct()
    urls = sized_broadcast(urls, hit_bound)
    pages = snapshot_pages(snapshot, urls)
    joined = hits.join(pages, "normalized_url", "left")
    max_chars = F.col("max_content_chars") if "max_content_chars" in hits.columns else F.lit(default_max_chars)
    fetched = F.col("page_id").isNotNull()
    allowed = F.coalesce((F.col("final_url") != "") & host_allowed("final_domain", blocked_host_tokens), F.lit(False))
    found = fetched & allowed
    failure = F.when(fetched, F.lit(K.STATUS_FALLBACK_PREFIX + "ValueError")).otherwise(F.lit(K.STATUS_FALLBACK_PREFIX + "HTTPError"))
    cols = resolved_columns(
        found, F.col("page_title"), F.col("readable_text"), F.col("title"), F.col("snippet"), max_chars, failure
    )
    url = F.when(found, F.col("final_url")).otherwise(F.col("normalized_url"))
    domain = F.when(found, F.col("final_domain")).otherwise(F.col("domain"))
    out = joined.withColumns(cols).withColumns(
        {"content": F.col("_outcome.content"), "fetch_status": F.col("_outcome.fetch_status")}
    )
    keep = [c for c in ("final_event_cap",) if c in hits.columns]
    return out.select(
        "run_id",
        "task_name",
        "arrival_seq",
        url.alias("url"),
        url.alias("normalized_url"),
        "title",
        "snippet",
        domain.alias("domain"),
        "content",
        F.length("content").alias("content_chars"),
        "fetch_status",
        F.lit(run_ts.replace(" ", "T")).alias("fetched_at"),
        R.domain_score(domain).alias("domain_score"),
        *keep,
    )
