"""Clustering features of deduplicated pages (inventory X5-X10, R2).

One projection: token set, title token set, version, release signature,
official bonus.  Computed once and reused by every merge rule (the original
recomputed them for every page-cluster comparison).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as R
from ..functions import text as X


def page_features(pages: DataFrame) -> DataFrame:
    df = pages.withColumns(
        {
            "tokens": X.page_token_set("title", "snippet", "content"),
            "title_tokens": X.title_token_set("title"),
            "version": X.page_version("title", "snippet", "content"),
            "official_bonus": R.official_bonus("domain"),
        }
    )
    return df.withColumn("signature", X.release_signature(F.col("title"), F.col("version")))
