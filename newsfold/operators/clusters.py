"""Cluster tables (inventory C8, D4-D8, T2, T3, W2).

Every cluster statistic is an aggregation with map-side combine
(``max_by``, ``min``, ``count``), so a cluster holding a third of all pages is
never gathered into one task.  Member lists (D5) and token unions (D6) stay
relations keyed by cluster instead of collected arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["run_id", "task_name"]
PAGE_COLS = [
    "seq",
    "url",
    "normalized_url",
    "title",
    "snippet",
    "domain",
    "content",
    "content_chars",
    "fetch_status",
    "fetched_at",
    "domain_score",
    "official_bonus",
]


def assign(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Members: feature rows with their cluster ``label``."""
    return features.join(labels.select(*GROUP, "seq", "label"), [*GROUP, "seq"])


def summarize(members: DataFrame) -> DataFrame:
    """One row per cluster.

    representative (D4): greatest (official_bonus, domain_score,
    content_chars), first member on ties; source_count (D8); release_signature
    (D7): signature of the earliest member that has one; first_seen: the
    cluster's earliest member (its creation position)."""
    rep_score = F.struct(
        "official_bonus", "domain_score", "content_chars", (-F.col("seq")).alias("neg_seq")
    )
    sig = F.when(F.col("signature") != "", F.struct("seq", "signature"))
    agg = members.groupBy(*GROUP, "label").agg(
        F.max_by(F.struct(*PAGE_COLS), rep_score).alias("rep"),
        F.count(F.lit(1)).alias("source_count"),
        F.min(sig).alias("_sig"),
        F.min("seq").alias("first_seen"),
    )
    return agg.select(
        *GROUP,
        "label",
        "first_seen",
        "rep",
        "source_count",
        F.coalesce(F.col("_sig.signature"), F.lit("")).alias("release_signature"),
    )


def rank(summary: DataFrame, caps: DataFrame | None = None, cap: int | None = None, max_cap: int | None = None) -> DataFrame:
    """T2 + T3 + W2: order by representative (domain_score, content_chars)
    descending, creation order on ties; keep ``final_event_cap`` per task;
    cluster_id = 1..n.  ``caps`` (task_name, final_event_cap) is
    configuration-sized and broadcast."""
    w = Window.partitionBy(*GROUP).orderBy(
        F.col("rep.domain_score").desc(), F.col("rep.content_chars").desc(), F.col("first_seen").asc()
    )
    if caps is None and cap is None:
        # no cap: every cluster gets a position; avoid a one-task window
        from .ranking import positions

        order = [F.col("rep.domain_score").desc(), F.col("rep.content_chars").desc(), F.col("first_seen").asc()]
        return positions(summary, GROUP, order, "cluster_id")
    if caps is not None:
        df = summary.join(F.broadcast(caps.select("task_name", "final_event_cap")), "task_name")
        limit = max_cap
    else:
        df = summary.withColumn("final_event_cap", F.lit(cap))
        limit = cap
    ranked = df.withColumn("cluster_id", F.row_number().over(w))
    if limit is not None:
        # a literal bound lets Catalyst insert a partial WindowGroupLimit
        # before the shuffle, so a task with millions of clusters ships only
        # ``limit`` rows per map partition to the final ranking
        ranked = ranked.filter(F.col("cluster_id") <= F.lit(limit))
    return ranked.filter(F.col("cluster_id") <= F.col("final_event_cap"))


def sources(members: DataFrame, ranked: DataFrame) -> DataFrame:
    """Members of the reported clusters, in arrival order (``seq``).
    The reported clusters are at most the sum of caps, so they broadcast."""
    top = F.broadcast(ranked.select(*GROUP, "label", "cluster_id", F.col("rep.seq").alias("rep_seq")))
    return members.join(top, [*GROUP, "label"]).select(
        *GROUP, "cluster_id", "label", "rep_seq", "seq", "title", "url", "domain"
    )


def cluster_tokens(members: DataFrame) -> DataFrame:
    """The union of member token sets as (cluster, token) rows."""
    return members.select(*GROUP, "label", F.explode("tokens").alias("token")).distinct()
