"""Version history kept up by change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deedmill.operators.dedupe import first_per_key
from deedmill.operators.history import SEGMENT_ROWS, scd2_history
from deedmill.session import cleans_up, staged
from deedmill.sources.buckets import merge_buckets, read_buckets


def _of(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) one of ``keys``, a NULL key being one like any other."""
    known = keys.select(F.struct(F.col(key).alias("k")).alias("_of")).distinct()
    return rows.withColumn("_of", F.struct(F.col(key).alias("k"))).join(known, "_of", how).drop("_of")


@cleans_up
def take_in_versions(
    batch: DataFrame,
    base: str,
    key: str,
    ts: str,
    attributes: Sequence[str],
    tiebreak: Sequence[Column],
    buckets: int | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> int:
    """Splice new or late versions into a stored history; returns the buckets of it that were written.

    All versions seen are kept beside the history, in buckets of their keys: one
    that changed nothing when it came starts an interval once a late one falls
    before it. Only the keys of the batch are worked out again, from their
    versions, and only their buckets are written, so that the history always is
    that of all versions, whatever the order and the batches they came in.
    """
    rows = staged(first_per_key(batch.select(key, ts, *attributes), [key, ts], tiebreak), "versions")

    def with_known(current: DataFrame | None, load: DataFrame) -> DataFrame:
        return load if current is None else first_per_key(current.unionByName(load), [key, ts], tiebreak)

    merge_buckets(rows, f"{base}/versions", [key], with_known, buckets)
    versions = read_buckets(rows.sparkSession, f"{base}/versions", of=rows)
    spliced = scd2_history(_of(versions, rows, key, "left_semi"), key, ts, attributes, tiebreak, segment_rows)

    def replaced(current: DataFrame | None, load: DataFrame) -> DataFrame:
        return load if current is None else _of(current, load, key, "left_anti").unionByName(load)

    return merge_buckets(spliced, f"{base}/history", [key], replaced, buckets)


def read_history(spark: SparkSession, base: str) -> DataFrame | None:
    return read_buckets(spark, f"{base}/history")
