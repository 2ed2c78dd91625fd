"""Connected components of an edge table, by contraction to stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import contracted


def component_roots(edges: DataFrame) -> DataFrame:
    """edges: a, b (long).  Returns node, root for every node of an edge; root is the
    smallest node of its component.  No task reads a component by its root."""
    stars = contracted(edges.select("a", "b"), [])
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
