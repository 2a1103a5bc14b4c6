"""Dense numbering and stable surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from deedmill.session import freeze

_SLOT_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Number rows 1..N in ``order`` without sorting them in one task.

    Rows are range-partitioned and sorted within partitions; a row's number is
    its place in the partition plus the rows in the partitions before it. The
    placed rows are frozen first: the ranges come from a sample, and counting
    and numbering must see the same ones.
    """
    placed = freeze(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_slot", _SLOT_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition of the numbering, so one window over all is small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    place = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)) + 1
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place)
        .drop("_part", "_slot", "_offset")
    )


def surrogate_keys(
    ids: DataFrame, natural: Sequence[str], name: str, known: DataFrame | None = None
) -> DataFrame:
    """Key table (natural key, surrogate key) for the distinct ``ids``.

    Known natural keys keep their number; new ones continue after the highest,
    densely and in natural-key order, so a rebuild never re-points a fact.
    """
    fresh = ids.select(*natural).distinct()
    if known is None:
        return dense_index(fresh, natural, name)
    fresh, (kept, top) = _known_of(freeze(fresh), natural, name, known)
    numbered = dense_index(fresh.join(kept, list(natural), "left_anti"), natural, name)
    return kept.unionByName(numbered.withColumn(name, F.col(name) + top))


def _known_of(
    rows: DataFrame, natural: Sequence[str], name: str, known: DataFrame
) -> tuple[DataFrame, tuple[DataFrame, int]]:
    """``rows``, their known keys, and the highest key of all.

    A small load is broadcast to the known keys, which are filtered where they
    lie; only what matches is joined afterwards.
    """
    known = known.select(*natural, F.col(name).cast("long").alias(name))
    top = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    return rows, (freeze(known.join(rows.select(*natural), list(natural), "left_semi")), top)


def attach_keys(
    df: DataFrame,
    natural: Sequence[str],
    name: str,
    known: DataFrame | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """``df`` (one row per natural key) with its surrogate key as first column.

    Whole rows are numbered, so that what made them runs once: right for a
    dimension, which is small beside the raw rows it comes from. For a fact,
    ``ids`` names a cheap frame with the same natural keys; those are numbered
    and joined back, and the wide rows are never moved for it.
    """
    natural = list(natural)
    if ids is not None:
        keys = surrogate_keys(ids, natural, name, known)
        return df.join(keys, natural).select(name, *df.columns)
    if known is None:
        return dense_index(df, natural, name).select(name, *df.columns)
    rows, (kept, top) = _known_of(freeze(df), natural, name, known)
    # rows without a key sort first and so get 1..M
    matched = rows.join(kept, natural, "left").withColumn("_known", F.col(name).isNotNull())
    numbered = dense_index(matched, ["_known", *natural], "_idx")
    return numbered.withColumn(name, F.coalesce(F.col(name), F.col("_idx") + top)).select(
        name, *df.columns
    )
