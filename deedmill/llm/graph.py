"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from deedmill.session import staged


#: Rows of a table of numbers that one task may work on: a few MB, whatever the corpus.
GATHERED_ROWS = 200_000


def gathered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again; in one partition if it is small, so that joins and
    aggregates of such tables need no exchange. Results are the same either way."""
    df = staged(df, name)
    return df.coalesce(1) if df.count() <= GATHERED_ROWS else df


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's greater neighbours are hung on its least one (itself included)."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of ``edges`` (``a``, ``b``, of one type).

    Loops, repeated edges and edges with a null end are allowed and link nothing
    new; an empty table gives an empty one. A node's least neighbour is found by
    an aggregate, which sends one row per node and map task however many edges
    the node has, and no group of neighbours is ever gathered. Every round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = gathered(edges, "edges")
    mark = None
    while True:
        edges = gathered(_small_star(gathered(_large_star(edges), "edges-large")), "edges-small")
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.union(roots).union(loops.join(nodes, "node", "left_anti")).distinct()
