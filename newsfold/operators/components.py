"""Connected components of the merge graph (inventory C2).

Alternating contraction to stars.  Edges point from the larger to the smaller
node.  A round first hangs every larger neighbour of a node on the smallest node
around it (large star), then every smaller neighbour of a node, and the node, on
the smallest of them (small star).  Rounds go on while an edge changes; what is
left has one edge from every node to the smallest node of its component, so an
edge is dropped where its two ends have met and long chains fold up in about
logarithmically many rounds.

No round gathers a component by its root: the smallest neighbours are partial
aggregates, and the edges look them up by a join that treats nodes of many edges
apart.  At most one node in HUB_ROWS edges, and at most HUBS of them, is such a
hub, so their lookups are broadcast and their edges stay where they are; all
other edges shuffle by node.  Each round's edges are cut from the lineage with a
reliable ``checkpoint()`` (into ``spark.checkpoint.dir``), so a lost executor
recomputes at most one round.

The label of a component is its smallest seq, i.e. the earliest page, which is
also the cluster's position in creation order.  Isolated pages keep their own
label; edges of a node to itself or with a null end join nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, ensure_checkpoint_dir

GROUP = ["run_id", "task_name"]
#: A hub has more edges than this, and more than a share of 1 / HUBS of all edges.
HUB_ROWS = 10_000
HUBS = 1_000


def looked_up(edges: DataFrame, table: DataFrame, keys: list[str], n_edges: int, hub_rows: int = HUB_ROWS) -> DataFrame:
    """Left join of edges to a table with one row per key; the edges of hubs are not shuffled."""
    limit = max(hub_rows, n_edges // HUBS)
    if n_edges <= limit:  # no node can be a hub
        return edges.join(table, keys, "left")
    hubs = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(*keys)
    hubs = F.broadcast(hubs)  # n_edges / limit rows at most
    of_hubs = F.broadcast(table.join(hubs, keys, "left_semi"))
    return edges.join(hubs, keys, "left_semi").join(of_hubs, keys, "left").unionByName(
        edges.join(hubs, keys, "left_anti").join(table, keys, "left")
    )


def contracted(edges: DataFrame, group: list[str], hub_rows: int = HUB_ROWS) -> DataFrame:
    """edges: group columns, a, b.  Returns group columns, node, root: every node of an
    edge but the smallest of its component, with that smallest node."""
    ensure_checkpoint_dir(edges.sparkSession)
    once = lambda df: df.groupBy(*group, "node", "root").agg(F.max("moved").alias("moved"))
    state = edges.filter("a <> b").select(
        *group, F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"), F.lit(True).alias("moved")
    )
    state = checkpointed(once(state))
    while True:
        n, moved = state.agg(F.count(F.lit(1)), F.max("moved")).first()
        if not moved:
            return state.drop("moved")
        below = state.groupBy(*group, F.col("node").alias("root")).agg(F.min("root").alias("low"))
        large = once(
            looked_up(state.drop("moved"), below, [*group, "root"], n, hub_rows).select(
                *group, "node", F.coalesce("low", "root").alias("root"), F.col("low").isNotNull().alias("moved")
            )
        )
        least = large.groupBy(*group, "node").agg(F.min("root").alias("low"), F.max("moved").alias("moved"))
        small = looked_up(large.drop("moved"), least.drop("moved"), [*group, "node"], n, hub_rows).filter("root <> low")
        turned = small.select(*group, F.col("root").alias("node"), F.col("low").alias("root"), F.lit(True).alias("moved"))
        state = checkpointed(once(turned.unionByName(least.withColumnRenamed("low", "root"))))


def component_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes: run_id, task_name, seq; edges: run_id, task_name, a, b.
    Returns run_id, task_name, seq, label."""
    labels = contracted(edges, GROUP).select(*GROUP, F.col("node").alias("seq"), F.col("root").alias("label"))
    return nodes.select(*GROUP, "seq").join(labels, [*GROUP, "seq"], "left").select(
        *GROUP, "seq", F.coalesce(F.col("label"), F.col("seq")).alias("label")
    )
