"""Connected components of an edge table by contraction, all on Spark.

Every node hooks onto its smallest neighbour, pointers are shortened, and the
edges are rewritten between the roots until none are left; each round at
least halves the nodes that still have edges.  A hub only takes part through
a pre-aggregated minimum and equi-joins that AQE can split.  Rounds are cut
by tables in the shared folder; only an emptiness test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillbook.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)`` with root = smallest node reachable.

    Only nodes with an edge appear.  Loops, repeats and null ends are ignored;
    an empty table gives an empty result.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                           .select("node", F.least("node", "m").alias("root")), "hook")
        step = hook
        for _ in range(3):
            step = _follow(step, hook)
        step = materialize(step, "step")
        labels = step if labels is None else materialize(_follow(labels, step), "labels")
        end = step.select(F.col("node").alias("n"), F.col("root").alias("r"))
        edges = materialize(
            edges.join(end.withColumnsRenamed({"n": "a", "r": "ra"}), "a")
            .join(end.withColumnsRenamed({"n": "b", "r": "rb"}), "b")
            .where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _follow(labels: DataFrame, by: DataFrame) -> DataFrame:
    """Replace each root by that root's own root, where it has one."""
    by = by.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return labels.join(by, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
