"""Page-level projections over the ``pages`` table (F1, F2, F3, U*, X3, P7).

``page_base`` is one narrow projection per page: canonical URL and domain,
<title> text, fallback text (F1), main content (F2) and readable text (F2, else
F1).  ``pages_as_resolved`` treats every page as one hit resolved to itself,
which is the input of the page-level dedup/cluster queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import html as H
from ..functions import scoring as R
from ..functions import text as X
from ..functions.common import let
from ..functions.dates import published_at
from ..functions.urls import with_canonical_url

CORPUS_TASK = "corpus"


def page_base(pages: DataFrame, with_main: bool = True, with_dates: bool = False) -> DataFrame:
    """page_id, url, normalized_url, domain, page_title, body_text
    [, main_text, readable_text] [, published]"""
    df = pages.select(
        "page_id",
        *([published_at("html").alias("published")] if with_dates else []),
        X.normalize_ws("url").alias("url"),
        H.html_title("html").alias("page_title"),
        H.strip_dropped_elements("html").alias("_clean"),
    )
    df = with_canonical_url(df, "url")
    cols = {"body_text": H.html_text("_clean")}
    if with_main:
        cols["main_text"] = H.main_content("_clean")
    df = df.withColumns(cols)
    if with_main:
        df = df.withColumn(
            "readable_text",
            F.when(F.col("main_text") != "", F.col("main_text")).otherwise(F.col("body_text")),
        )
    return df.drop("_clean")


def search_snippet(body_text) -> Column:
    """Snippet a search index shows for a page: the X3 excerpt of its text."""
    return X.excerpt(body_text)


def resolved_columns(
    found: Column,
    page_title: Column,
    readable_text: Column,
    hit_title: Column,
    snippet: Column,
    max_chars: Column,
    fallback_status: Column | None = None,
) -> dict:
    """S6/P7/F3 as columns.

    Found: content = X2(readable text, else snippet); title = page title, else
    hit title; status 'ok' or 'empty_content'; an empty content falls back to
    the raw snippet.  Not found: content = X2(snippet), hit title, status
    ``fallback_status``."""
    text = F.when(F.coalesce(readable_text, F.lit("")) != "", readable_text).otherwise(snippet)
    source = F.when(found, text).otherwise(snippet)
    title = F.when(F.coalesce(page_title, F.lit("")) != "", page_title).otherwise(hit_title)
    cleaned = X.clean_text(source, max_chars)
    outcome = let(
        cleaned,
        lambda c: F.struct(
            F.when(found & (c == ""), snippet).otherwise(c).alias("content"),
            F.when(found, F.when(c != "", F.lit(K.STATUS_OK)).otherwise(F.lit(K.STATUS_EMPTY)))
            .otherwise(F.lit(K.STATUS_FALLBACK_PREFIX + "HTTPError") if fallback_status is None else fallback_status)
            .alias("fetch_status"),
        ),
    )
    return {
        "title": F.when(found, title).otherwise(hit_title),
        "_outcome": outcome,
    }


def pages_as_resolved(
    pages: DataFrame,
    max_chars: int = K.DEFAULT_MAX_CONTENT_CHARS,
    run_id: str = K.DEFAULT_RUN_ID,
    run_ts: str = K.DEFAULT_RUN_TS,
    task_name: str = CORPUS_TASK,
) -> DataFrame:
    """Every page as a hit of one task, resolved to itself (pages failing P1,
    i.e. without title or canonical URL, are not hits).

    run_id, task_name, arrival_seq (= page_id), url, normalized_url, title,
    snippet, domain, content, content_chars, fetch_status, fetched_at,
    domain_score"""
    base = page_base(pages).filter((F.col("normalized_url") != "") & (F.col("page_title") != ""))
    df = base.withColumn("snippet", search_snippet("body_text"))
    cols = resolved_columns(
        F.lit(True),
        F.col("page_title"),
        F.col("readable_text"),
        F.col("page_title"),
        F.col("snippet"),
        F.lit(max_chars),
    )
    df = df.withColumns(cols).withColumns(
        {"content": F.col("_outcome.content"), "fetch_status": F.col("_outcome.fetch_status")}
    )
    return df.select(
        F.lit(run_id).alias("run_id"),
        F.lit(task_name).alias("task_name"),
        F.col("page_id").alias("arrival_seq"),
        F.col("normalized_url").alias("url"),
        "normalized_url",
        "title",
        "snippet",
        "domain",
        "content",
        F.length("content").alias("content_chars"),
        "fetch_status",
        F.lit(run_ts.replace(" ", "T")).alias("fetched_at"),
        R.domain_score("domain").alias("domain_score"),
    )
