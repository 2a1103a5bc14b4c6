"""The version that was valid at a row's time: one sort and a carried value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from deedmill.operators.history import SEGMENT_ROWS, micros, segment_starts

#: Ways in which rows without a key are spread.
SPREAD = 2048


def _carried_over_cuts(cut: DataFrame) -> DataFrame:
    """Per segment of a hot key, the last version before it."""
    last = cut.where(F.col("_kind") == 0).groupBy("_key", "_segment").agg(
        F.max(F.struct("_at", "_value")).alias("_last")
    )
    segments = cut.select("_key", "_segment").distinct().join(last, ["_key", "_segment"], "left")
    earlier = Window.partitionBy("_key").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last("_last", ignorenulls=True).over(earlier)
    return segments.select("_key", "_segment", carried["_value"].alias("_carried"))


def lookup_as_of(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    is_key: Column,
    spread_by: Column,
    starts: str = "valid_from",
    ends: str | None = "valid_to",
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Left lookup adding ``columns`` of the version of ``key`` that is valid at ``at``.

    That is the last with ``starts`` not after ``at``, unless it ended by then
    (``ends``, exclusive; NULL is open). A version without a start has been
    valid ever since. Rows before the first version, without a time or whose key
    is no key (``is_key`` false) get NULLs; the row count never changes. Of
    versions with one key and start the last by its columns counts.

    Rows and versions are one table, sorted by key and time once, along which
    the last version is carried; there is no join on a range. Keys with very many
    rows are cut in time and sorted apart (the version at a cut comes from one
    row per segment), and rows without a key are spread by ``spread_by``.
    """
    value = F.struct(*[F.col(c) for c in columns], *([F.col(ends).alias("_ends")] if ends else []))
    when = lambda c: F.col(c).cast("timestamp").alias("_at")
    versions = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), when(starts), F.lit(0).alias("_kind"), value.alias("_value")
    )
    facts = rows.select(
        F.when(is_key, F.col(key)).alias("_key"), when(at), F.lit(1).alias("_kind"),
        F.struct(*rows.columns).alias("_row"), spread_by.alias("_spread"),
    )
    # a fact without a time comes after the versions without a start: it is told apart below
    both = versions.unionByName(facts, allowMissingColumns=True)
    cuts = segment_starts(both.select("_key", "_at").where("_key IS NOT NULL"), "_key", "_at", segment_rows)
    slot = -1 - F.pmod(F.xxhash64("_spread"), F.lit(SPREAD))
    segment = F.when(F.col("_key").isNull(), slot).otherwise(0)
    carried = F.lit(None).cast(versions.schema["_value"].dataType)
    if cuts is not None:
        passed = F.size(F.filter("_starts", lambda start: start <= micros("_at")))
        # bounded: the segments of hot keys
        both = both.join(F.broadcast(cuts), "_key", "left")
        segment = F.when(F.col("_starts").isNotNull() & F.col("_at").isNotNull(), passed).otherwise(segment)
        both = both.withColumn("_segment", segment.cast("long"))
        edges = _carried_over_cuts(both.where(F.col("_starts").isNotNull()).select("_key", "_segment", "_at", "_kind", "_value"))
        both = both.join(F.broadcast(edges), ["_key", "_segment"], "left")
        carried = F.col("_carried")
    else:
        both = both.withColumn("_segment", segment.cast("long"))
    upto = Window.partitionBy("_key", "_segment").orderBy(F.asc_nulls_first("_at"), "_kind", "_value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = F.coalesce(F.last("_value", ignorenulls=True).over(upto), carried)
    valid = F.col("_at").isNotNull() & F.col("_key").isNotNull()
    placed = both.withColumn("_found", F.when(valid, found)).where("_kind = 1")
    if ends:
        over = F.col("_found._ends").isNotNull() & (F.col("_at") >= F.col("_found._ends").cast("timestamp"))
        placed = placed.withColumn("_found", F.when(~over, F.col("_found")))
    return placed.select("_row.*", *[F.col("_found")[c].alias(c) for c in columns])
