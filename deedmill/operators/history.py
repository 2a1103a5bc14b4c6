"""Version history (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from deedmill.operators.dedupe import first_per_key
from deedmill.session import freeze

SEGMENT_ROWS = 1_000_000
MAX_SEGMENTS = 15_000  # over all keys, beside one per hot key
QUANTILES = 5_000


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def segment_starts(
    versions: DataFrame, key: str, ts: str, segment_rows: int
) -> DataFrame | None:
    """Cut points in time for keys with too many versions to sort in one task.

    A segment aims at ``segment_rows`` rows, or 1/``MAX_SEGMENTS`` of all rows
    where that is more; keys with more rows than that are hot, so there are
    fewer than ``MAX_SEGMENTS`` of them. None where no key is hot. Cut points
    come from a quantile sketch and are frozen, for two passes use them.
    """
    counts = versions.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = freeze(
        counts.withColumn("_size", F.greatest(F.lit(segment_rows), total / MAX_SEGMENTS)).where(
            F.col("_n") > F.col("_size")
        )
    )
    if hot.isEmpty():
        return None
    steps = F.expr("array(" + ", ".join(f"{i / QUANTILES}D" for i in range(1, QUANTILES)) + ")")
    cuts = (
        versions.join(F.broadcast(hot), key)
        .groupBy(key, F.ceil(F.col("_n") / F.col("_size")).alias("_wanted"))
        .agg(F.percentile_approx(micros(ts), steps, 10 * QUANTILES).alias("_q"))
    )
    stride = F.greatest(F.floor(F.lit(QUANTILES) / F.col("_wanted")), F.lit(1))
    starts = F.array_distinct(F.filter("_q", lambda q, i: F.pmod(i + 1, stride) == 0))
    return freeze(cuts.select(key, starts.alias("_starts")))


def _segment_edges(hot: DataFrame, key: str, ts: str, before: Column) -> DataFrame:
    """Per segment of a hot key: the value before it, and the next change after it."""
    changed = F.col("_before").isNotNull() & (F.col("_before") != F.col("_value"))
    summary = (
        hot.withColumn("_before", before)
        .withColumn("_changed", changed)
        .groupBy(key, "_segment")
        .agg(
            F.min(ts).alias("_first_ts"),
            F.min_by("_value", ts).alias("_first_value"),
            F.max_by("_value", ts).alias("_last_value"),
            F.min(F.when(F.col("_changed"), F.col(ts))).alias("_changed_ts"),
        )
    )
    segments = Window.partitionBy(key).orderBy("_segment")
    later = segments.rowsBetween(1, Window.unboundedFollowing)
    summary = summary.withColumn("_carried", F.lag("_last_value").over(segments))
    opens = F.col("_carried").isNull() | (F.col("_carried") != F.col("_first_value"))
    change = F.when(opens, F.col("_first_ts")).otherwise(F.col("_changed_ts"))
    return (
        summary.withColumn("_change", change)
        .withColumn("_next_change", F.min("_change").over(later))
        .select(key, "_segment", "_carried", "_next_change")
    )


def scd2_history(
    versions: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    tiebreak: Sequence[Column],
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Validity intervals of each key's attribute values.

    Versions equal to the one before them are dropped; the rest get
    ``valid_from``, ``valid_to`` (start of the next, NULL for the last) and
    ``is_current``. Of versions with one key and time, ``tiebreak`` picks one.

    A key with very many versions is cut into time segments that are sorted in
    separate tasks. What crosses a cut (last values before it, first change
    after it) is worked out on one summary row per segment.
    """
    name, key = key, "_key"
    # a struct is never NULL and equals another with NULL inside, so a NULL key is joined and cut like any other
    versions = first_per_key(versions.select(name, ts, *attributes), [name, ts], tiebreak).select(
        F.struct(name).alias(key), ts, F.struct(*attributes).alias("_value")
    )
    in_segment = Window.partitionBy(key, "_segment").orderBy(ts)
    before = F.lag("_value").over(in_segment)
    starts = segment_starts(versions.select(key, ts), key, ts, segment_rows)
    if starts is None:
        in_segment = Window.partitionBy(key).orderBy(ts)
        placed = versions.withColumn("_before", F.lag("_value").over(in_segment))
        next_change = F.lead(ts).over(in_segment)
    else:
        passed = F.size(F.filter("_starts", lambda start: start <= micros(ts)))
        # bounded: fewer than MAX_SEGMENTS keys, about two cuts per segment aimed at
        cut = versions.join(F.broadcast(starts), key, "left").withColumn(
            "_segment", F.coalesce(passed, F.lit(0))
        )
        edges = _segment_edges(cut.where(F.col("_starts").isNotNull()), key, ts, before)
        placed = (
            cut.drop("_starts")
            .join(F.broadcast(edges), [key, "_segment"], "left")
            .withColumn("_before", F.coalesce(before, F.col("_carried")))
        )
        next_change = F.coalesce(F.lead(ts).over(in_segment), F.col("_next_change"))
    changes = placed.where(F.col("_before").isNull() | (F.col("_before") != F.col("_value")))
    return changes.select(
        F.col(key)[name].alias(name),
        *[F.col("_value")[a].alias(a) for a in attributes],
        F.col(ts).alias("valid_from"),
        next_change.alias("valid_to"),
        next_change.isNull().alias("is_current"),
    )
