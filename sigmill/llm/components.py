"""Connected components of an edge table by hooking to the smallest neighbour, pointer jumping and contraction.

Every round's tables are written to the shared folder and deleted when the next round's stand; nothing but whether a
table is empty reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import forget, materialize

JUMPS = 2


def _follow(left: DataFrame, col: str, parent: DataFrame) -> DataFrame:
    """left with `col` replaced by its parent where it has one. A plain join: AQE splits a hot value of col."""
    p = parent.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return left.join(p, left[col] == p["_node"], "left").withColumn(col, F.coalesce("_root", col)).drop("_node", "_root")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b), longs without nulls -> (node, root) for every node of an edge; root is its component's smallest node.

    Self loops, repeated and reversed edges are fine; an empty table gives an empty result.
    """

    def contracted(df: DataFrame) -> DataFrame:
        return materialize(df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")

    edges, labels = contracted(edges), None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "parent")
        for _ in range(JUMPS):
            before, parent = parent, materialize(_follow(parent, "root", parent), "parent")
            forget(before)
        old, was = labels, edges
        labels = parent if labels is None else materialize(_follow(labels, "root", parent), "labels")
        edges = contracted(_follow(_follow(edges, "a", parent), "b", parent))
        forget(was, old, parent if labels is not parent else None)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    forget(edges)
    return labels
