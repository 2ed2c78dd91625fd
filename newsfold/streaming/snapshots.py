"""Scheduled runs as a Structured Streaming query.

The original is a batch job started by a scheduler once per task and day.  The
Spark equivalent keeps one streaming query over a directory of page
snapshots: each new snapshot file is one micro-batch, processed exactly once
(file source + checkpoint), which runs the whole triage for all tasks as one
batch job via ``foreachBatch``, writing reports and stage tables under a run id
derived from the stream's name and the batch id.  ``trigger(availableNow=True)`` gives the
"process what arrived, then stop" behaviour of a scheduled run.

The streaming checkpoint lives under the session's ``spark.checkpoint.dir``
(shared storage on a cluster) unless a location is given.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.triage import run_triage
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from ..sources.tasks import TaskConfig

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def start_snapshot_runs(
    spark: SparkSession,
    snapshot_dir: str,
    cfg: TaskConfig,
    out_dir: str,
    checkpoint_location: str | None = None,
    cluster_mode: str = "refined",
    name: str = "snapshots",
    available_now: bool = True,
):
    """Start the streaming query; returns the ``StreamingQuery``."""
    location = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    stream = spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", 1).parquet(snapshot_dir)

    def run_batch(pages: DataFrame, batch_id: int) -> None:
        run_cfg = replace(cfg, run_id=f"{name}_b{batch_id}", run_ts=None)  # the time of this run
        result = run_triage(pages.sparkSession, pages, run_cfg, cluster_mode=cluster_mode)
        # run ids derive from the batch id, and sinks overwrite only their own
        # partitions, so a re-executed batch replaces its output (idempotent)
        sinks.write_json_report(result.json_blocks, f"{out_dir}/json")
        sinks.write_markdown_report(result.markdown_rows, f"{out_dir}/markdown")
        sinks.write_stage_tables(result, f"{out_dir}/stages")

    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
