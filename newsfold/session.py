"""Spark session helpers.

The library never creates a cluster session itself; ``get_spark`` is for
tests, the benchmark and local runs.  Lineage cuts use reliable checkpoints in
the folder named by ``spark.checkpoint.dir``; a machine-local folder is only
made when the session has none and runs in local mode.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "newsfold") -> SparkSession:
    master = master or os.environ.get("NEWSFOLD_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("NEWSFOLD_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    Uses the context's folder or ``spark.checkpoint.dir``; only a local-mode
    session without either gets a fresh folder under the system temp dir."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder the executors can reach"
        )
    path = tempfile.mkdtemp(prefix="newsfold-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: What Spark takes for the bytes of a table of which it knows nothing.
UNKNOWN_BYTES = (1 << 63) - 1


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint that stands for a table of unknown size.

    A checkpoint keeps the size that Spark guessed for its plan, and guesses that of a join as
    the product of both sides.  Where each round of a loop joins what the rounds before it cut, the
    guess gets several times as many digits a round, until the driver's heap is full of them.
    """
    done = df.checkpoint()
    if not hasattr(done, "_jdf"):  # Spark Connect: the plan is the server's
        return done
    plan = done._jdf.queryExecution().optimizedPlan()
    if plan.stats().sizeInBytes() <= UNKNOWN_BYTES:
        return done
    return type(done)(done.sparkSession._jsparkSession.internalCreateDataFrame(plan.rdd(), done._jdf.schema(), False), done.sparkSession)
