"""Groups of candidates whose main component changes while they are settled."""

import numpy as np
from pyspark.sql import functions as F

from deedmill.llm import minhash
from deedmill.llm.graph import components


def test_members_of_a_former_main_component_are_called(spark):
    """A is main first; B and C merge in the first step and outgrow it. Only x of A and y of B link the two."""
    rank = F.pmod(F.xxhash64(F.lit(0).cast("long"), "id"), F.lit(1 << 40)) / float(1 << 40) * 100
    ranks = {r["id"]: r["rank"] for r in spark.range(400).withColumn("rank", rank).collect()}
    early = [k for k in ranks if ranks[k] < minhash.FIRST_STEP]
    late = [k for k in ranks if ranks[k] >= minhash.FIRST_STEP]
    x, y = early[0], late[0]
    a, b, c = [x, *late[1:40]], [y, *early[1:15], *late[40:55]], [*early[15:30], *late[55:70]]
    assert len({*a, *b, *c}) == 100 and len(b + c) > len(a) > len(b) == len(c)

    same = np.arange(1000, 1040, dtype=np.uint64)
    held = {k: same if k in early else np.arange(10_000 + 100 * k, 10_040 + 100 * k, dtype=np.uint64) for k in a + b + c}
    held[x] = held[y] = np.arange(50, 90, dtype=np.uint64)
    sets = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in held.items()], "node long, shingles binary")
    links = spark.createDataFrame([(min(k, p[0]), max(k, p[0])) for p in (a, b, c) for k in p[1:]], "a long, b long")
    known = minhash._Known(sets, spark.createDataFrame([], "a long, b long"), links, components(links), 85)
    groups = spark.createDataFrame([(0, k, 40, 0) for k in held], "key long, node long, n int, place int")
    minhash._settle(groups, known)
    assert {r["component"] for r in known.labels.collect()} == {min(held)}
