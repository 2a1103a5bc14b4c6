"""Sharding by balanced label propagation. DataFrame functions only.

Documents with equal texts are linked. A document's shard is its label; in every
round a document of a split group wants to go where most of its group already is,
and quotas decide how many may go: what flows from one shard to another is at most
what flows back plus an equal part of the free room. The labels then are made to
fit exactly: every shard keeps its documents in the order of their company, and
those beyond its size fill the room of others.

Joined are documents with the counts of their group per shard, never with each
other. The state is a small table (no texts), written after each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from deedmill.session import staged

ROUNDS = 6
#: Room of a shard during the rounds, over an equal share; at the end documents without company make way.
SLACK = 0.1
#: Groups of more than this part of a shard are moved document by document, others as one.
WHOLE = 0.02


def _unit(*what) -> Column:
    """A number in [0, 1) that depends on its arguments only."""
    return F.pmod(F.xxhash64(*what), F.lit(1 << 40)) / float(1 << 40)


def with_places(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``place``: gapless numbers from 0 per value of ``keys``, in the order given.

    Rows are dealt out by range over (keys, order), so a key with very many rows
    is numbered by many tasks: each counts its own rows, and the counts of the
    tasks, one row per task and key, are added up.
    """
    ordered = staged(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")),
        name,
    )
    counts = ordered.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    # bounded by tasks times keys: one row for each stretch that a task has numbered
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.equal_null(k, f"_{k}")
    return (
        ordered.join(starts, same)
        .withColumn("place", F.col("_before") + F.col("_row") - F.col("_first"))
        .drop("_part", "_row", "_p", "_first", "_before", *[f"_{k}" for k in keys])
    )


def _propagate(members: DataFrame, loads: list[int], share: float, turn: int) -> DataFrame:
    """One round over all documents (``uid``, ``name``, ``text_key``, ``shard`` and more): new shards.

    ``loads`` are the rows per shard.
    """
    shards = len(loads)
    cells = members.groupBy("text_key", "shard").agg(F.count("*").alias("n"))
    groups = cells.groupBy("text_key").agg(
        # most of the group; of equal shards any, so that as many groups go one way as the other
        F.max_by("shard", F.col("n") * (1 << 20) + F.pmod(F.xxhash64("text_key", "shard"), F.lit(1 << 20))).alias("target"),
        F.sum("n").alias("group_rows"),
        F.count("*").alias("parts"),
    )
    split = groups.where("parts > 1").select(
        F.col("text_key").alias("group"), "target", "group_rows"
    )
    large = F.col("group_rows") > WHOLE * share
    wishes = cells.join(split, F.col("text_key") == F.col("group")).where("shard <> target")
    flows = {
        (r["shard"], r["target"], r["large"]): r["n"]  # two rows at most for each pair of shards
        for r in wishes.groupBy("shard", "target", large.alias("large")).agg(F.sum("n").alias("n")).collect()
    }
    into = {(t, g): sum(n for (_, k, h), n in flows.items() if (k, h) == (t, g)) for t in range(shards) for g in (True, False)}
    part = F.lit(0.0)
    for (s, t, g), n in flows.items():
        room = max(0.0, share * (1 + SLACK) - loads[t])
        back, here = flows.get((t, s, False), 0), flows.get((s, t, False), 0)
        if g:  # a large group takes what others leave, or it would keep them all apart
            allowed = max(0, back - here) + max(0.0, room - into[t, False]) * n / into[t, True]
        else:
            allowed = back + flows.get((t, s, True), 0) + room * n / into[t, False]
        here = (F.col("shard") == s) & (F.col("target") == t) & (large == g)
        part = F.when(here, F.lit(min(1.0, allowed / n))).otherwise(part)
    chance = F.when(large, _unit("name", F.lit(turn))).otherwise(_unit("text_key", "shard", F.lit(turn)))
    goes = F.col("target").isNotNull() & (F.col("shard") != F.col("target")) & (chance < part)
    return members.join(split, F.col("text_key") == F.col("group"), "left").select(
        "uid", "name", "text_key", F.when(goes, F.col("target")).otherwise(F.col("shard")).alias("shard")
    )


def _loads(df: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in df.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    return [found.get(k, 0) for k in range(shards)]


def shard_documents(
    docs: DataFrame, *, shards: int = 8, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    The law is ``rows``: the rows of two shards differ by one at most, and
    ``slot`` numbers those of a shard from 0 without gaps. ``size`` is the UTF-8
    bytes of the text plus 1; a null text counts as an empty one. Equal texts are
    linked and share a shard where the law leaves room; a group larger than a
    shard fills several. Rows with null or repeated ids are rows like others.
    ``grown_shard`` is null under this law. An empty table gives an empty one.
    Other columns are not read. Ids and texts decide, not how the table lies in
    files.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    facts = staged(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_key"),
            # what a row does hangs on its name; its number tells equal rows apart, of which any may do it
            F.xxhash64(F.col(id_col), text).alias("name"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard-facts",
    )
    total = facts.count()
    share = total / shards
    state = staged(
        facts.select("uid", "name", "text_key", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int").alias("shard")),
        "shard-labels",
    )
    for turn in range(rounds):
        state = staged(_propagate(state, _loads(state, shards), share, turn), "shard-labels")

    company = state.groupBy("text_key", "shard").agg(F.count("*").alias("company"))
    placed = staged(
        with_places(
            state.join(company, ["text_key", "shard"]), ["shard"], [F.desc("company"), F.asc("text_key"), F.asc("name"), F.asc("uid")], "shard-order"
        ),
        "shard-places",
    )
    loads = _loads(state, shards)
    quota = [total // shards + (k < total % shards) for k in range(shards)]

    def of_shard(numbers: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(n).cast("long") for n in numbers]), F.col("shard") + 1)

    stays = placed.where(F.col("place") < of_shard(quota)).select("uid", "shard", F.col("place").alias("slot"))
    over = placed.where(F.col("place") >= of_shard(quota)).drop("place")
    moved = with_places(over, [], [F.asc("shard"), F.desc("company"), F.asc("text_key"), F.asc("name"), F.asc("uid")], "shard-over")
    shard, slot, taken = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for k in range(shards):
        free = max(0, quota[k] - loads[k])
        here = (F.col("place") >= taken) & (F.col("place") < taken + free)
        shard = F.when(here, F.lit(k)).otherwise(shard)
        slot = F.when(here, F.col("place") - taken + loads[k]).otherwise(slot)
        taken += free
    moved = moved.select("uid", shard.alias("new_shard"), slot.alias("slot")).withColumnRenamed("new_shard", "shard")
    final = stays.unionByName(moved)
    return facts.join(final, "uid").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
