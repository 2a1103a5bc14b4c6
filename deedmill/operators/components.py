"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deedmill.operators.skew import lookup_left
from deedmill.session import staged


def _lookup(df: DataFrame, roots: DataFrame, column: str, spread: list[str], **limits) -> DataFrame:
    """``column`` replaced by its root where it has one."""
    dim = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    found = lookup_left(df, dim, column, ["_root"], F.lit(True), F.struct(*spread), **limits)
    return found.withColumn(column, F.coalesce("_root", column)).drop("_root")


def _ends(hooks: DataFrame, **limits) -> DataFrame:
    """Where following hooks ends; each round doubles the step."""
    while True:
        further = staged(_lookup(hooks.withColumn("_was", F.col("root")), hooks, "root", ["node"], **limits), "component-ends")
        if further.where("root <> _was").isEmpty():
            return further.drop("_was")
        hooks = further.drop("_was")


def components(edges: DataFrame, **limits) -> DataFrame:
    """``node`` and ``root``, the least node it reaches, for every node of ``edges`` (``a``, ``b``).

    Every node hangs itself on its least neighbour if that is below it, chains
    are followed to their end, and edges are drawn anew between those ends. Of
    the nodes of a component only local minima are left, half of them at most,
    so a few rounds do. A node's least neighbour is an aggregate and its edges
    are looked up around hot keys, so that no neighbourhood comes to one task.
    Loops and repeated edges are allowed; ``limits`` are those of the lookup.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = staged(pairs, "component-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = staged(nodes.withColumn("root", F.col("node")), "component-labels")
    while not pairs.isEmpty():
        hooks = staged(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "component-hooks")
        roots = _ends(hooks, **limits)
        labels = staged(_lookup(labels, roots, "root", ["node"], **limits), "component-labels")
        drawn = _lookup(_lookup(pairs, roots, "a", ["a", "b"], **limits), roots, "b", ["a", "b"], **limits)
        drawn = drawn.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        pairs = staged(drawn.distinct(), "component-edges")
    return labels
