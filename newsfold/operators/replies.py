"""Search replies as text (inventory S2, W3).

A reply is line-oriented text: a line containing "Search Results" opens the
result list; ``n. **title**`` opens an item; an indented ``URL:`` line sets
its URL; the first following line starting with ``(`` is the snippet and
emits the item (only when it has a title and a URL).  Items without such a
line, or whose ``(`` line comes before the URL, are dropped.

The parser is a fold over the lines of one reply (``aggregate`` with a struct
state), evaluated per row on the JVM: no explode, no window, no shuffle.  The
item number is the running count of title lines (W3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

TITLE_LINE_RE = "^" + K.REPLY_TITLE_LINE
URL_LINE_RE = "^" + K.REPLY_URL_LINE
SECTION_MARKER = K.REPLY_SECTION_MARKER
ITEM_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_no", T.IntegerType()),
            T.StructField("title", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("snippet", T.StringType()),
        ]
    )
)


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, "^" + K.WS + "|" + K.WS + "$", "")


def render_replies(hits: DataFrame) -> DataFrame:
    """One reply per (task_name, query_idx), items in rank order.  A reply
    holds at most top_k items, so the per-query collect is bounded."""
    item = F.concat(
        F.col("rank").cast("string"), F.lit(". **"), F.col("title"), F.lit("**\n   URL: "), F.col("url"),
        F.lit("\n("), F.col("provider"), F.lit(") "), F.col("snippet"),
    )
    agg = hits.groupBy("task_name", "query_idx").agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))).alias("items"))
    return agg.select(
        "task_name",
        "query_idx",
        F.concat(
            F.lit(SECTION_MARKER + " for query "), F.col("query_idx").cast("string"), F.lit("\n"),
            F.array_join(F.transform("items", lambda x: x["item"]), "\n"),
        ).alias("body"),
    )


def _step(acc: Column, line: Column) -> Column:
    stripped = strip_ws(line)
    in_res = acc["in_res"]
    has = acc["has"]
    is_sr = F.instr(line, SECTION_MARKER) > 0
    is_title = stripped.rlike(TITLE_LINE_RE)
    is_url = line.rlike(URL_LINE_RE)
    active = in_res & ~is_sr
    c_title = active & is_title
    c_url = active & ~is_title & is_url & has
    c_paren = active & ~is_title & ~c_url & has & stripped.startswith(K.REPLY_SNIPPET_OPENER)
    emit = c_paren & (acc["title"] != "") & (acc["url"] != "")
    new_item = F.struct(
        acc["n"].alias("item_no"), acc["title"].alias("title"), acc["url"].alias("url"), stripped.alias("snippet")
    )
    return F.struct(
        (in_res | is_sr).alias("in_res"),
        F.when(c_title, F.lit(True)).when(c_paren, F.lit(False)).otherwise(has).alias("has"),
        F.when(c_title, F.regexp_extract(stripped, TITLE_LINE_RE, 1)).otherwise(acc["title"]).alias("title"),
        F.when(c_title, F.lit("")).when(c_url, strip_ws(F.regexp_extract(line, URL_LINE_RE, 1))).otherwise(acc["url"]).alias("url"),
        F.when(c_title, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
        F.when(emit, F.array_append(acc["out"], new_item)).otherwise(acc["out"]).alias("out"),
    )


def parse_replies(replies: DataFrame, body_col: str = "body") -> DataFrame:
    """(reply keys..., item_no, title, url, snippet)."""
    zero = F.struct(
        F.lit(False).alias("in_res"),
        F.lit(False).alias("has"),
        F.lit("").alias("title"),
        F.lit("").alias("url"),
        F.lit(0).alias("n"),
        F.array().cast(ITEM_TYPE).alias("out"),
    )
    keys = [c for c in replies.columns if c != body_col]
    items = F.aggregate(F.split(F.coalesce(F.col(body_col), F.lit("")), "\n"), zero, _step, lambda acc: acc["out"])
    return replies.select(*keys, F.explode(items).alias("it")).select(*keys, "it.*")
