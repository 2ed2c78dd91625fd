"""Deduplication (inventory D2, D3, J2, R3).

Both steps elect winners on narrow rows (keys, scores, positions) with
``max_by`` over a lexicographic struct, so Spark combines map-side and a
canonical URL or a title key carried by a third of all rows never lands whole
in one task; page content is not part of these aggregations.  The surviving
rows then get their content back by one join on their arrival position.

D2: one row per canonical URL, greatest (domain_score, content_chars), ties
to the earliest arrival; ``first_seen`` = the first sighting of the URL, which
is the row's position in all later steps (``seq``).
D3: one row per non-empty title key, same score, ties to the smallest
first_seen; empty keys are dropped (``mode='strict'``) or pass through
(``mode='unicode'``, keys keep any letter or digit).  J2 is folded in: the
title winners are exactly the D2 rows that survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

GROUP = ("run_id", "task_name")


def _url_winners(resolved: DataFrame) -> DataFrame:
    """D2 without content: keys, arrival_seq, title, scores, first_seen."""
    narrow = ["arrival_seq", "title", "domain_score", "content_chars"]
    score = F.struct("domain_score", "content_chars", (-F.col("arrival_seq")).alias("neg_seq"))
    agg = resolved.groupBy(*GROUP, "normalized_url").agg(
        F.max_by(F.struct(*narrow), score).alias("w"),
        F.min("arrival_seq").alias("first_seen"),
    )
    return agg.select(*GROUP, "normalized_url", "w.*", "first_seen")


def _rows_of(resolved: DataFrame, winners: DataFrame, *added: str) -> DataFrame:
    return resolved.join(winners.select(*GROUP, "arrival_seq", *added), [*GROUP, "arrival_seq"])


def url_dedup(resolved: DataFrame) -> DataFrame:
    """D2.  Adds ``first_seen``.  ``arrival_seq`` is unique in a task."""
    return _rows_of(resolved, _url_winners(resolved), "first_seen")


def title_key_column(title, mode: str = "strict"):
    if mode == "strict":
        return X.title_key(title)
    if mode == "unicode":
        toks = F.filter(
            F.split(F.regexp_replace(F.lower(X.normalize_ws(title)), r"[^\p{L}\p{N} ]", " "), " "),
            lambda x: F.length(x) > 2,
        )
        return F.array_join(F.slice(toks, 1, 12), " ")
    raise ValueError(f"unknown title key mode {mode!r}")


def _title_winners(urls: DataFrame, mode: str) -> DataFrame:
    """D3 + J2 over D2 winners, without content."""
    keyed = urls.withColumn("title_key", title_key_column(F.col("title"), mode))
    if mode == "unicode":
        # pages without a key are kept as their own group
        keyed = keyed.withColumn(
            "_tk", F.when(F.col("title_key") == "", F.concat(F.lit("\u0000url:"), "normalized_url")).otherwise(F.col("title_key"))
        )
    else:
        keyed = keyed.filter(F.col("title_key") != "").withColumn("_tk", F.col("title_key"))
    score = F.struct("domain_score", "content_chars", (-F.col("first_seen")).alias("neg_seen"))
    agg = keyed.groupBy(*GROUP, "_tk").agg(F.max_by(F.struct("arrival_seq", "first_seen", "title_key"), score).alias("w"))
    return agg.select(*GROUP, "w.*")


def title_dedup(urls: DataFrame, mode: str = "strict") -> DataFrame:
    """D3 + J2 over D2 output.  Adds ``title_key``."""
    return _rows_of(urls, _title_winners(urls, mode), "title_key")


def dedupe_pages(resolved: DataFrame, mode: str = "strict") -> DataFrame:
    """D2 then D3; adds ``first_seen``, ``title_key`` and ``seq`` = first_seen
    (unique per surviving page)."""
    winners = _title_winners(_url_winners(resolved), mode)
    return _rows_of(resolved, winners, "first_seen", "title_key").withColumn("seq", F.col("first_seen"))
