"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped edges.

1. One pass over the texts gives, per document, the size and a digest of its
   shingle set and the hashes of its signature's bands.
2. Equal sets are one *class* from here on, so copies cost a row each, no more.
3. Classes that share a band are candidates. First every class is compared with
   one centre only: of the centres of its buckets (the class of a bucket with
   most company in all its buckets) the one it meets most often.
4. Compared are full sets, recomputed from the texts of candidates only. What is
   linked is one component.
5. Buckets that still hold several components are *open*. In small ones every
   class meets those of other components. Classes of large ones, mostly texts that
   share a long passage, are indexed by the rarest shingles of their sets instead:
   of two sets as similar as asked for, both have a common one among these
   (prefix filter), and its places bound the intersection (positional filter).
   Such groups of classes are *settled* by steps: some members meet the whole
   group, what is linked is merged, then eight times as many, until all had their
   turn; members of the group's main component need none as long as it is that.
   Merges can make another component the main one: who was passed over for being in
   it is called late. So no pair that shares a band is skipped unless its ends are
   linked already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from deedmill.llm.graph import components, gathered
from deedmill.session import staged

WORDS = 5
#: 24 bands of 5 rows miss a pair of similarity 0.85 with a chance below 1e-6, one of 0.8 below 1e-4.
BANDS, ROWS = 24, 5
#: Classes in an open bucket in which all meet all of other components.
SMALL = 16
#: Members of a group that meet the whole group in the first step, and by what these grow from step to step.
FIRST_STEP, GROWTH = 32, 8
#: Classes of a step's pairs that are sent to every task, so that the sets of all others stay where they are.
BROADCAST_NODES = 500_000

_P1, _P2, _P3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _P1
    x = (x ^ (x >> np.uint64(27))) * _P2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; those of a short text are its whole word sequence."""
    found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    state = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        state = _mix((state + _P3) ^ hashes[k : len(found) - width + 1 + k])
    return np.unique(state)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash: the least value per bin; an empty bin takes that of the
    first filled bin in its own pseudo-random sequence, which all sets share."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    values = np.full(bins, empty)
    np.minimum.at(values, (hashes % np.uint64(bins)).astype(np.int64), _mix(hashes + _P3) >> np.uint64(1))
    filled = values != empty
    todo = np.flatnonzero(~filled)
    if filled.sum() == 1:
        values[todo] = values[filled][0]
        return values
    out, attempt = values.copy(), 0
    while len(todo):
        attempt += 1
        donor = (_mix((todo + 1).astype(np.uint64) * _P3 + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = filled[donor]
        out[todo[hit]] = values[donor[hit]]
        todo = todo[~hit]
    return out


def band_hashes(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    state = np.arange(1, bands + 1, dtype=np.uint64) * _P3
    for column in values.reshape(bands, rows).T:
        state = _mix((state + _P3) ^ column)
    return state.view(np.int64)


#: A row is told apart by id and text, in 128 bits.
ROW_KEYS = ["row_key", "row_key_2"]


def text_hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def row_keys(id_: Column, hash_1: Column, hash_2: Column) -> list[Column]:
    """``ROW_KEYS`` of an id and the two hashes of a text."""
    return [F.xxhash64(id_, hash_1).alias("row_key"), F.xxhash64(F.lit(1), id_, hash_2).alias("row_key_2")]


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """``id``, ``text_hash``, ``text_hash_2``, ``n_shingles``, ``set_key`` and ``b0``, ``b1``, … per row; without words the last are null."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("text_hash_2", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.StringType()),
            *[T.StructField(f"b{k}", T.LongType()) for k in range(bands)],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, found = [], [], np.zeros((batch.num_rows, bands), np.int64)
            for k, text in enumerate(batch.column("text")):
                hashes = shingles(text.as_py(), words)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_hexdigest(hashes.tobytes()) if len(hashes) else None)
                if len(hashes):
                    found[k] = band_hashes(signature(hashes, bands * rows), bands, rows)
            none = np.array([k is None for k in keys], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("text_hash"),
                    batch.column("text_hash_2"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.string()),
                    *[pa.array(np.ascontiguousarray(found[:, k]), mask=none) for k in range(bands)],
                ],
                schema.names,
            )

    hashes = [h.alias(c) for h, c in zip(text_hashes(F.col(text_col)), ("text_hash", "text_hash_2"))]
    return docs.select(F.col(id_col).alias("id"), *hashes, F.col(text_col).alias("text")).mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``node`` and ``shingles`` (sorted 64-bit hashes) of wanted classes (``node``, ``rep_id``, ``rep_hash``)."""
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = keyed.select(*row_keys(F.col("id"), *text_hashes(F.col("text"))), "text")
    rep = (F.col("rep_id"), F.col("rep_hash.text_hash"), F.col("rep_hash.text_hash_2"))
    keys = wanted.select("node", *row_keys(*rep))
    # one row per class, also where the row of its representative is repeated; sorted for the join already
    found = texts.join(keys, ROW_KEYS).dropDuplicates(ROW_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"])

    return found.select("node", "text").mapInArrow(run, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, per_hundred: int) -> DataFrame:
    """Pairs (``a``, ``b``) with 100 * intersection >= per_hundred * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= per_hundred * (len(x) + len(y) - both))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
            yield out.filter(pa.array(linked, pa.bool_()))

    nodes = gathered(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "minhash-nodes")
    if nodes.count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    if pairs.count() <= BROADCAST_NODES:
        pairs = F.broadcast(pairs)
    needed = sets.join(nodes, "node", "left_semi")
    joined = (
        pairs.join(needed.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(needed.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        .select("a", "b", "set_a", "set_b")
    )
    return joined.mapInArrow(run, "a long, b long")


@dataclass
class _Known:
    """What is known of the classes so far."""

    sets: DataFrame
    tested: DataFrame
    links: DataFrame
    labels: DataFrame
    per_hundred: int

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the component of ``node``; without links a class is a component of its own."""
        return df.join(self.labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def learn(self, pairs: DataFrame) -> None:
        fresh = gathered(pairs.join(self.tested, ["a", "b"], "left_anti"), "minhash-pairs")
        if fresh.isEmpty():
            return
        found = gathered(_verified(fresh, self.sets, self.per_hundred), "minhash-links")
        self.tested = gathered(self.tested.union(fresh), "minhash-tested")
        if not found.isEmpty():
            self.links = gathered(self.links.union(found), "minhash-links")
            self.labels = gathered(components(self.links), "minhash-labels")


def _open_groups(placed: DataFrame) -> DataFrame:
    """Groups (``key``) of several components, with their size and the component of most members (of several the last)."""
    cells = placed.groupBy("key", "component").agg(F.count("*").alias("n_in"))
    main = F.max_by("component", F.struct("n_in", "component")).alias("main")
    return (
        cells.groupBy("key").agg(F.sum("n_in").alias("size"), F.count("*").alias("parts"), main).where("parts > 1")
    )


def _settle(groups: DataFrame, known: _Known) -> None:
    """Compare what is in one group (``key``, ``node``, ``n``, ``place``) and not in one component.

    ``place`` is that of the group's shingle in the order of the set's shingles (0
    if the group has none): nothing before it is common with the first such group.
    The end is when all members outside of the main components that now are have
    been called: of two ends apart one is outside, and at its call it met the other.
    """
    step = 0
    groups = groups.withColumn("was_called", F.lit(False))
    while True:
        placed = known.placed(groups)
        rank = F.pmod(F.xxhash64("key", "node"), F.lit(1 << 40)) / float(1 << 40) * F.col("size")
        turn = F.floor(F.log(1 + (GROWTH - 1) * rank / FIRST_STEP) / math.log(GROWTH)).cast("int")
        waiting = placed.join(_open_groups(placed), "key").withColumn("turn", turn)
        waiting = gathered(waiting, "minhash-open")
        due = (F.col("component") != F.col("main")) & ~F.col("was_called")
        if waiting.where(due).isEmpty():
            return
        now = due & (F.col("turn") <= step)
        called = waiting.where(now).select(
            "key",
            F.col("node").alias("x"),
            F.col("n").alias("x_n"),
            F.col("place").alias("x_place"),
            F.col("component").alias("x_component"),
        )
        most = F.least(F.col("n") - F.col("place"), F.col("x_n") - F.col("x_place"))
        can = 100 * most >= known.per_hundred * (F.col("n") + F.col("x_n") - most)
        apart = F.col("component") != F.col("x_component")
        met = waiting.select("key", "node", "n", "place", "component").join(
            called, (waiting["key"] == called["key"]) & apart & can
        )
        known.learn(met.select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct())
        # groups that are one component by now stay so
        groups = waiting.select("key", "node", "n", "place", (F.col("was_called") | now).alias("was_called"))
        step += 1


def _rare_shingles(nodes: DataFrame, sets: DataFrame, per_hundred: int) -> DataFrame:
    """Groups of ``nodes`` (``node``, ``n``) by the shingles of their prefixes.

    Shingles are ordered by how many of the nodes have them. Two sets of n and m
    with the similarity asked for have ``overlap`` elements in common or more, so
    the first common one is among the first n - overlap + 1 of either set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, packed in zip(batch.column("node"), batch.column("n"), batch.column("shingles")):
                hashes = np.frombuffer(packed.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes),
                        pa.array(np.full(len(hashes), node.as_py(), np.int64)),
                        pa.array(np.full(len(hashes), n.as_py(), np.int32)),
                    ],
                    ["key", "node", "n"],
                )

    rows = staged(
        nodes.join(sets, "node").select("node", "n", "shingles").mapInArrow(run, "key long, node long, n int"),
        "minhash-shingles",
    )
    shared = rows.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    # shingles of one holder come first and are in no group: only how many there are matters
    common = rows.join(shared, "key")
    own = Window.partitionBy("node").orderBy("holders", "key")
    ranked = common.withColumns(
        {"nth": F.row_number().over(own), "in_common": F.count("*").over(Window.partitionBy("node"))}
    )
    place = F.col("n") - F.col("in_common") + F.col("nth") - 1
    overlap = F.ceil(F.col("n") * per_hundred / 100)
    return ranked.withColumn("place", place.cast("int")).where(F.col("place") <= F.col("n") - overlap).select(
        "key", "node", "n", "place"
    )


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    per_hundred: int = 85,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``, ``component``, ``row_key`` and ``row_key_2``.

    Documents are linked if 100 times the intersection of their shingle sets is
    at least ``per_hundred`` times the union; a component is what links reach, and
    ``component_id`` its least id. Texts without words (null, empty, blank) link
    with nothing, not even with each other, and are components of their own.
    Null ids take part; they are never the least unless all ids of a component
    are null, and ``kept`` compares null-safely. Repeated rows keep a row each
    and are judged alike. ``component`` numbers components of texts with words,
    ``row_key`` and ``row_key_2`` are a hash of id and text. Other columns are not read.
    """
    text_hash = F.struct("text_hash", "text_hash_2")
    sig = staged(signatures(docs, id_col, text_col, words, bands, rows), "minhash-signatures")
    classes = (
        sig.where("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("id").alias("rep_id"),
            F.coalesce(F.min_by(text_hash, "id"), F.min(text_hash)).alias("rep_hash"),
            F.max("n_shingles").alias("n"),
            *[F.max(f"b{k}").alias(f"b{k}") for k in range(bands)],
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    # written once: the numbers of the nodes are facts from here on
    classes = staged(classes, "minhash-classes")

    entries = classes.select(
        "node", F.col("n").cast("int").alias("n"), F.explode(F.array(*[f"b{k}" for k in range(bands)])).alias("bucket")
    )
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    members = staged(entries.join(shared, "bucket"), "minhash-members")

    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    centres = (
        members.join(company, "node")
        .groupBy("bucket")
        .agg(F.max_by("node", F.col("company") * (1 << 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))).alias("centre"))
    )
    met = members.join(centres, "bucket").where("node <> centre").groupBy("node", "n", "centre").agg(F.count("*").alias("times"))
    first = met.groupBy("node", "n").agg(
        F.max_by("centre", F.col("times") * (1 << 40) + F.pmod(F.xxhash64("centre"), F.lit(1 << 40))).alias("centre")
    )
    sizes = classes.select(F.col("node").alias("centre"), F.col("n").alias("centre_n"))
    pairs = (
        first.join(sizes, "centre")
        .where(100 * F.least("n", "centre_n") >= per_hundred * F.greatest("n", "centre_n"))
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .distinct()
    )

    wanted = members.select("node").distinct().join(classes.select("node", "rep_id", "rep_hash"), "node")
    sets = staged(_sets(docs, wanted, id_col, text_col, words), "minhash-sets")

    tested = gathered(pairs, "minhash-pairs")
    links = gathered(_verified(tested, sets, per_hundred), "minhash-links")
    known = _Known(sets, tested, links, gathered(components(links), "minhash-labels"), per_hundred)
    groups = members.select(F.col("bucket").alias("key"), "node", "n", F.lit(0).alias("place"), "members")
    _settle(gathered(groups.where(F.col("members") <= SMALL).drop("members"), "minhash-small"), known)
    large = known.placed(groups.where(F.col("members") > SMALL))
    waiting = staged(large.join(_open_groups(large), "key").select("node", "n").distinct(), "minhash-waiting")
    if not waiting.isEmpty():
        _settle(gathered(_rare_shingles(waiting, sets, per_hundred), "minhash-prefixes"), known)

    placed = classes.select("set_key", "node", "rep_id").join(known.labels, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    named = placed.join(least, "component").select("set_key", "component_id", "component")
    return (
        sig.select("id", "text_hash", "text_hash_2", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            "component",
            *row_keys(F.col("id"), F.col("text_hash"), F.col("text_hash_2")),
        )
        .withColumn("kept", F.equal_null(id_col, "component_id"))
        .select(id_col, "n_shingles", "component_id", "kept", "component", *ROW_KEYS)
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, all columns unchanged: the one with the least id.

    Of several rows with that id the one with the least hash stays, of equal rows
    one. Texts without words stay, repeated rows of them once. ``options`` are
    those of ``near_duplicates``.
    """
    rows = docs.select(F.struct(F.col("*")).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = near_duplicates(rows, id_col="id", text_col="text", **options).where("kept")
    key = F.struct(*ROW_KEYS)
    alone = F.col("component").isNull()
    of_its_own = F.when(alone, key)
    keepers = found.groupBy("component", of_its_own).agg(F.min(key).alias("keeper")).select("keeper.*").distinct()
    keyed = rows.select("row", *row_keys(F.col("id"), *text_hashes(F.col("text"))))
    place = F.row_number().over(Window.partitionBy(*ROW_KEYS).orderBy("row_key"))
    kept = keyed.join(keepers, ROW_KEYS, "left_semi").withColumn("place", place).where("place = 1")
    return kept.select("row.*")
