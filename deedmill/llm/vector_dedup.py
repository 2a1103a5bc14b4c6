"""Near-duplicate vectors by a random-projection tree forest.

1. Equal vectors are one *class*; only classes go on.
2. Every class goes down ``TREES`` trees. A level splits all leaves that are still
   too large, each at the median of its own projections on a random direction;
   classes close to the median go both ways, twice on their way at most. The
   quantiles are aggregates, so neither a node nor the trees ever meet in one task
   or the driver, and there is no sample.
3. In a leaf all vectors are compared. What is linked is reported as a star, one
   edge per vector, and joined to components over all leaves and trees.
4. Links lie inside components, so the links of a vector are counted by comparing
   each component with itself, in blocks. This finds also those links of a
   component that no leaf has shown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from deedmill.llm.graph import components, gathered
from deedmill.session import staged

TREES = 8
#: Classes in a leaf that is not split further.
LEAF = 768
#: Part of a node around its median that goes both ways, and how often that may happen to one class.
OVERLAP, DOUBLINGS = 0.12, 2
#: Classes of a component that are compared in one task, with as many others.
BLOCK = 2048


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of one length, scaled to length 1, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # in two steps: squares of very large or very small components leave the range of doubles
    rows = rows / np.abs(rows).max(axis=1, keepdims=True) if len(rows) else rows
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _projections(classes: DataFrame, trees: int, levels: int, seed: int) -> DataFrame:
    """``node``, ``tree``, ``leaf`` and the projections ``p`` for the levels of that tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dim in np.unique(table["dim"].to_numpy()):
                own = table.filter(pa.compute.equal(table["dim"], int(dim)))
                directions = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), trees * levels))
                found = (_matrix(own["vector"]) @ directions).astype(np.float32).reshape(-1, levels)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own["node"].to_numpy(), trees)),
                        pa.array(np.repeat(own["dim"].to_numpy(), trees)),
                        pa.array(np.tile(np.arange(trees, dtype=np.int32), len(own))),
                        pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), levels).cast(pa.list_(pa.float32())),
                    ],
                    ["node", "dim", "tree", "p"],
                )

    found = classes.select("node", "dim", "vector").mapInArrow(run, "node long, dim int, tree int, p array<float>")
    return found.select("node", F.xxhash64("tree", "dim").alias("leaf"), F.lit(0).alias("doubled"), "p")


def leaves(classes: DataFrame, *, trees: int, leaf: int, seed: int) -> DataFrame:
    """``node`` and ``leaf``: all leaves that a class has come to."""
    count = classes.count()
    levels = max(1, math.ceil(math.log2(max(2.0, count / leaf))) + 4)
    state = staged(_projections(classes, trees, levels, seed), "forest")
    for level in range(levels):
        x = F.get("p", F.lit(level)).cast("double")
        cuts = (
            state.groupBy("leaf")
            .agg(
                F.count("*").alias("rows"),
                F.percentile_approx(x, [0.5 - OVERLAP / 2, 0.5, 0.5 + OVERLAP / 2], 1000).alias("at"),
            )
            .where((F.col("rows") > leaf) & (F.get("at", F.lit(0)) < F.get("at", F.lit(2))))
            .drop("rows")
        )
        cuts = staged(cuts, "forest-cuts")
        if cuts.isEmpty():
            break
        at = [F.get("at", F.lit(k)) for k in range(3)]
        near = (F.col("doubled") < DOUBLINGS) & (x >= at[0]) & (x < at[2])
        sides = (
            F.when(F.col("at").isNull(), F.array(F.lit(-1)))
            .when(near, F.array(F.lit(0), F.lit(1)))
            .otherwise(F.array(F.when(x < at[1], 0).otherwise(1)))
        )
        state = (
            state.join(cuts, "leaf", "left")
            .withColumns({"near": near & F.col("at").isNotNull(), "side": sides})
            .select("node", "leaf", "doubled", "p", "near", F.explode("side").alias("side"))
            .select(
                "node",
                F.when(F.col("side") < 0, F.col("leaf")).otherwise(F.xxhash64("leaf", "side")).alias("leaf"),
                (F.col("doubled") + F.coalesce("near", F.lit(False)).cast("int")).alias("doubled"),
                "p",
            )
        )
        state = staged(state, "forest")
    return state.select("node", "leaf")


def _star(table: pa.Table, least: float) -> pa.Table:
    """Each vector of a leaf that is linked there, with the first vector that its links reach."""
    x, nodes = _matrix(table["vector"]), table["node"].to_numpy()
    order = np.argsort(nodes)
    x, nodes = x[order], nodes[order]
    label = np.arange(len(x))
    a, b = [], []
    for at in range(0, len(x), BLOCK):
        i, j = np.nonzero(x[at : at + BLOCK] @ x.T >= least)
        a.append(i + at)
        b.append(j)
    a, b = np.concatenate(a), np.concatenate(b)
    apart = a != b
    a, b = a[apart], b[apart]
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            break
        label = low
    linked = label != np.arange(len(x))
    return pa.table({"a": pa.array(nodes[linked]), "b": pa.array(nodes[label[linked]])})


def _degrees(members: DataFrame, least: float) -> DataFrame:
    """``node`` and ``links``: rows in other classes linked to each class (``node``, ``component``, ``times``, ``vector``)."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    seated = members.join(sizes, "component").withColumn(
        "seat", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # block i of a component meets block j once; a component of one block is one group
    sent = seated.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component",
        F.least("seat", "other").alias("i"),
        F.greatest("seat", "other").alias("j"),
        "seat",
        "node",
        "times",
        "vector",
    )

    def count(table: pa.Table) -> pa.Table:
        x, nodes = _matrix(table["vector"]), table["node"].to_numpy()
        times, seat = table["times"].to_numpy().astype(np.float64), table["seat"].to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        out = np.zeros(len(x))
        for left, right in ((seat == i, seat == j), (seat == j, seat == i))[: 1 + (i != j)]:
            left, right = np.flatnonzero(left), np.flatnonzero(right)
            for at in range(0, len(left), BLOCK):
                rows = left[at : at + BLOCK]
                linked = x[rows] @ x[right].T >= least
                if i == j:
                    linked[np.arange(len(rows)), np.arange(at, at + len(rows))] = False
                out[rows] += linked @ times[right]
        return pa.table({"node": pa.array(nodes), "links": pa.array(out.astype(np.int64))})

    return (
        sent.groupBy("component", "i", "j")
        .applyInArrow(count, "node long, links long")
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )


def near_vectors(
    rows: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    trees: int = TREES,
    leaf: int = LEAF,
    seed: int = 7,
) -> DataFrame:
    """One row per row of ``rows``: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors are linked if their cosine, in double precision, is at least
    ``least``. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; vectors of different length never link. Equal
    vectors link with each other. ``component_id`` is the least id that links
    reach. Null ids take part; they are the least only if all ids of a component
    are null, and ``kept`` compares null-safely. Repeated rows keep a row each and
    count as other vectors. Other columns are not read. An empty table gives an
    empty one.
    """
    keyed = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).select(
        "id",
        F.when(_usable(F.col("vector")), F.col("vector")).alias("vector"),
    )
    # two hashes name a vector
    keyed = keyed.select(
        "id",
        "vector",
        F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("k1"),
        F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(1), "vector")).alias("k2"),
    )
    classes = staged(
        keyed.where("k1 is not null")
        .groupBy("k1", "k2")
        .agg(F.min("id").alias("rep"), F.count("*").alias("times"), F.first("vector").alias("vector"))
        .select("*", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("node")),
        "vector-classes",
    )
    vectors = classes.select("node", "vector")
    met = leaves(classes, trees=trees, leaf=leaf, seed=seed).join(vectors, "node")
    edges = met.groupBy("leaf").applyInArrow(lambda table: _star(table, least), "a long, b long").distinct()
    labels = gathered(components(edges), "vector-labels")
    linked = labels.join(classes.select("node", "rep", "times", "vector"), "node")
    degrees = _degrees(linked.select("node", "component", "times", "vector"), least)
    firsts = linked.groupBy("component").agg(F.min("rep").alias("first"))
    found = (
        classes.select("k1", "k2", "node", "rep", "times")
        .join(labels.select("node", "component"), "node", "left")
        .join(firsts, "component", "left")
        .join(degrees, "node", "left")
        .select(
            F.col("k1").alias("c1"),
            F.col("k2").alias("c2"),
            (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("first", "rep").alias("component_id"),
        )
    )
    return (
        keyed.select("id", "k1", "k2")
        .join(found, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.equal_null(id_col, "component_id"))
    )
