"""Positions 1..n inside a few large groups without a one-task window (W1 and
T2 when no top-k limit applies).

A window ``row_number() OVER (PARTITION BY g ORDER BY k)`` puts a whole group
into one task; when a group holds a third of all rows that task sorts a third
of the data.  Instead the rows are range-partitioned and sorted on (g, k)
across all tasks, every row gets its partition id and offset inside the
partition (``monotonically_increasing_id``), the sorted data is cut from its
lineage (so recomputation cannot renumber it), and a small table of per
(group, partition) counts — at most partitions x groups-per-partition rows —
gives each partition's starting position by a running sum.  One broadcast join
turns local offsets into global positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

LOW_BITS = (1 << 33) - 1


def positions(df: DataFrame, group: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with ``name`` = 1-based position of each row inside its group in
    ``order`` (ties broken by the order columns only, so pass a unique key
    last)."""
    keys = [F.col(g) for g in group] + list(order)
    tagged = checkpointed(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumns({"_pid": F.shiftright("_mid", 33), "_idx": F.col("_mid").bitwiseAND(F.lit(LOW_BITS))})
    counts = tagged.groupBy(*group, "_pid").agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select(*group, "_pid", "_first", "_off")), [*group, "_pid"])
    return out.withColumn(name, F.col("_off") + F.col("_idx") - F.col("_first") + F.lit(1)).drop(
        "_mid", "_pid", "_idx", "_first", "_off"
    )
