"""Sinks (inventory K1, K2, K3, K4).

Every output is written by executors, partitioned by ``task_name`` and
``run_id`` (one run id per run, so the JSON and Markdown of a run share a name
and tasks never overwrite each other, unlike a wall-clock file name per task).

* K1 JSON: the ordered text blocks of ``report.json_blocks`` written as text
  after a global sort; the part files of a task, in name order, are one JSON
  document.
* K2 Markdown: the blocks of ``report.markdown_rows``, written alike.
* K3 stage tables: hits, resolved pages, deduplicated pages and clusters as
  Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _writer(df: DataFrame, mode: str):
    # dynamic partition overwrite replaces only the (task_name, run_id)
    # partitions being written: other runs stay, and a retried run (a
    # re-executed streaming batch) replaces its own output instead of
    # duplicating it
    return df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("task_name", "run_id")


def _write_blocks(blocks: DataFrame, path: str, mode: str) -> None:
    ordered = blocks.orderBy("task_name", "run_id", "cluster_id", "part", "seq")
    _writer(ordered.select("task_name", "run_id", F.col("text").alias("value")), mode).text(path)


def write_json_report(json_blocks: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_blocks(json_blocks, path, mode)


def write_markdown_report(markdown_rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_blocks(markdown_rows, path, mode)


def write_stage_tables(result, path: str, mode: str = "overwrite") -> None:
    """K3: the stage tables of one run as Parquet."""
    stages = {
        "hits": result.hits,
        "resolved": result.resolved,
        "deduped": result.deduped,
        "clusters": result.ranked.select("run_id", "task_name", "cluster_id", "label", "first_seen", "source_count", "release_signature", "rep"),
    }
    for name, df in stages.items():
        _writer(df, mode).parquet(f"{path.rstrip('/')}/{name}")
