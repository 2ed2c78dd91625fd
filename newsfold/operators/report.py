"""Report rows (inventory K1, K2, P8, N1, N2).

Reports are relations, not strings assembled on the driver:

* K1 rows: one row per (reported cluster, source) with the cluster's JSON
  fields.
* K1 document: the JSON text as ordered blocks (task_name, cluster_id, part,
  seq, text), one line per cluster head, source and closing bracket, so a
  cluster of any size is never nested whole in one row.  A task without
  clusters has a document with an empty list.
* K2 rows: the Markdown document as ordered text blocks
  (task_name, cluster_id, part, seq, text); joining the blocks of a task in
  (cluster_id, part, seq) order with newlines gives the document.  The header
  block has cluster_id 0.

Markdown lists "Additional Sources" when a cluster has more than one source.
By default the list leaves out the representative; ``compat_skip_first=True``
leaves out the earliest source instead, as the original did.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K

GROUP = ["run_id", "task_name"]
#: cluster_id of the block that ends a JSON document.
JSON_END = (1 << 31) - 1


def iso_ts(run_ts: str) -> str:
    return run_ts.replace(" ", "T")


def slug(ts: Column) -> Column:
    """yyyy_MM_dd_HHmmss."""
    return F.date_format(ts, "yyyy_MM_dd_HHmmss")


def json_rows(ranked: DataFrame, srcs: DataFrame, run_ts: str = K.DEFAULT_RUN_TS) -> DataFrame:
    """K1 flattened: cluster fields repeated per source."""
    total = F.count(F.lit(1)).over(Window.partitionBy(*GROUP))
    head = ranked.select(
        *GROUP,
        "cluster_id",
        total.alias("total_clusters"),
        F.col("rep.title").alias("title"),
        F.col("rep.url").alias("url"),
        F.col("rep.domain").alias("domain"),
        F.col("rep.fetch_status").alias("status"),
        F.col("rep.content_chars").alias("content_chars"),
        F.substring(F.col("rep.content"), 1, K.JSON_CONTENT_CHARS).alias("content"),
        "source_count",
    )
    s = srcs.select(
        *GROUP,
        "cluster_id",
        F.col("seq").alias("source_seq"),
        F.col("title").alias("source_title"),
        F.col("url").alias("source_url"),
        F.col("domain").alias("source_domain"),
    )
    return head.join(s, [*GROUP, "cluster_id"]).withColumn("generated_at", F.lit(iso_ts(run_ts)))


def _open_object(doc: Column, name: str) -> Column:
    """JSON of a struct, left open at a list that follows as its last field."""
    text = F.to_json(doc, {"ignoreNullFields": "false"})
    return F.concat(F.regexp_replace(text, r"\}\z", ""), F.lit(f',"{name}":['))


def json_blocks(ranked: DataFrame, srcs: DataFrame, task_names: DataFrame, run_ts: str) -> DataFrame:
    """K1 document.  ``task_names`` (run_id, task_name): every task of the run."""
    columns = [*GROUP, "cluster_id", "part", "seq", "text"]

    def block(part: int, text: Column, seq: Column | None = None) -> list[Column]:
        return [F.lit(part).alias("part"), (F.lit(0) if seq is None else seq).cast("long").alias("seq"), text.alias("text")]

    counts = ranked.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    tasks = task_names.join(counts, GROUP, "left").select(*GROUP, F.coalesce("n", F.lit(0)).cast("long").alias("total_clusters"))
    head = F.struct("task_name", F.lit(iso_ts(run_ts)).alias("generated_at"), "total_clusters")
    cluster = F.struct(
        F.col("cluster_id").cast("long").alias("id"),
        F.col("rep.title").alias("title"),
        F.col("rep.url").alias("url"),
        F.col("rep.domain").alias("domain"),
        F.col("rep.fetch_status").alias("status"),
        F.col("rep.content_chars").cast("long").alias("content_chars"),
        F.substring(F.col("rep.content"), 1, K.JSON_CONTENT_CHARS).alias("content"),
        F.col("source_count").cast("long").alias("source_count"),
    )
    comma = F.when(F.col("cluster_id") > 1, F.lit(",")).otherwise(F.lit(""))
    # the earliest source of a cluster has no comma before it
    first = srcs.groupBy(*GROUP, "cluster_id").agg(F.min("seq").alias("first"))
    source = F.to_json(F.struct("title", "url", "domain"), {"ignoreNullFields": "false"})
    listed = srcs.join(first, [*GROUP, "cluster_id"])
    source_comma = F.when(F.col("seq") > F.col("first"), F.lit(",")).otherwise(F.lit(""))
    end = F.lit(JSON_END).cast("long").alias("cluster_id")
    parts = [
        tasks.select(*GROUP, F.lit(0).cast("long").alias("cluster_id"), *block(0, _open_object(head, "clusters"))),
        ranked.select(*GROUP, F.col("cluster_id").cast("long"), *block(1, F.concat(comma, _open_object(cluster, "sources")))),
        listed.select(*GROUP, F.col("cluster_id").cast("long"), *block(2, F.concat(source_comma, source), F.col("seq"))),
        ranked.select(*GROUP, F.col("cluster_id").cast("long"), *block(3, F.lit("]}"))),
        tasks.select(*GROUP, end, *block(4, F.lit("]}"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*columns)


def _preview(content: Column) -> Column:
    n = K.MARKDOWN_PREVIEW_CHARS
    return F.when(F.length(content) > n, F.concat(F.substring(content, 1, n), F.lit(K.MD_ELLIPSIS))).otherwise(content)


def fmt(template: str, **cols) -> Column:
    """A format line from ``constants`` with ``{name}`` placeholders filled
    by columns: one ``concat`` of literals and columns."""
    parts = []
    for lit_part, name in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if lit_part:
            parts.append(F.lit(lit_part))
        if name:
            parts.append(cols[name].cast("string"))
    return F.concat(*parts)


def lines(*cols: Column) -> Column:
    return F.concat_ws("\n", *cols)


def markdown_rows(
    ranked: DataFrame,
    srcs: DataFrame,
    run_ts: str = K.DEFAULT_RUN_TS,
    compat_skip_first: bool = False,
    task_names: DataFrame | None = None,
) -> DataFrame:
    """K2 blocks.  ``task_names`` (run_id, task_name) gives every task a
    header even when it has no cluster."""
    r = F.col
    empty = F.lit("")
    section = lines(
        fmt(K.MD_SECTION, i=r("cluster_id"), title=r("rep.title")),
        empty,
        fmt(K.MD_URL, url=r("rep.url")),
        fmt(K.MD_DOMAIN, domain=r("rep.domain")),
        fmt(K.MD_STATUS, status=r("rep.fetch_status")),
        fmt(K.MD_LENGTH, chars=r("rep.content_chars")),
        fmt(K.MD_SOURCES, n=r("source_count")),
        empty,
        F.lit(K.MD_PREVIEW),
        empty,
        _preview(r("rep.content")),
        empty,
    )
    multi = r("source_count") > 1
    blocks = ranked.select(
        *GROUP,
        "cluster_id",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("seq"), section.alias("text")),
                F.struct(
                    F.lit(1).alias("part"),
                    F.lit(0).cast("long").alias("seq"),
                    F.when(multi, lines(F.lit(K.MD_MORE), empty)).alias("text"),
                ),
                F.struct(
                    F.lit(3).alias("part"),
                    F.lit(0).cast("long").alias("seq"),
                    F.when(multi, lines(empty, F.lit(K.MD_RULE), empty))
                    .otherwise(lines(F.lit(K.MD_RULE), empty))
                    .alias("text"),
                ),
            )
        ).alias("b"),
    ).select(*GROUP, "cluster_id", "b.part", "b.seq", "b.text").filter(F.col("text").isNotNull())

    if compat_skip_first:
        first = srcs.groupBy(*GROUP, "cluster_id").agg(F.min("seq").alias("skip_seq"))
        listed = srcs.join(first, [*GROUP, "cluster_id"]).filter(F.col("seq") != F.col("skip_seq"))
    else:
        listed = srcs.filter(F.col("seq") != F.col("rep_seq"))
    source_lines = listed.select(
        *GROUP,
        "cluster_id",
        F.lit(2).alias("part"),
        "seq",
        fmt(K.MD_SOURCE_LINE, title=r("title"), url=r("url"), domain=r("domain")).alias("text"),
    )
    names = task_names if task_names is not None else ranked.select(*GROUP).distinct()
    header = names.select(
        *GROUP,
        F.lit(0).alias("cluster_id"),
        F.lit(0).alias("part"),
        F.lit(0).cast("long").alias("seq"),
        lines(fmt(K.MD_HEADER, task=r("task_name")), fmt(K.MD_GENERATED, ts=F.lit(iso_ts(run_ts))), F.lit("")).alias("text"),
    )
    return header.unionByName(blocks).unionByName(source_lines)
