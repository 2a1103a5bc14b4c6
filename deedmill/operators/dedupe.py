"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first in ``order``, which must be total.

    ``row_number() = 1`` lets Spark cut every map task down to one row per key
    before the shuffle (WindowGroupLimit), so a key that holds a third of the
    table sends no more rows than a rare one.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[Column | str] = ()
) -> DataFrame:
    """The newest row of each key; a missing time is oldest, ties go to ``tiebreak``."""
    ties = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in tiebreak]
    return first_per_key(df, keys, [F.desc_nulls_last(ts), *ties])


def distinct_ids(df: DataFrame, key: str, is_id: Column) -> DataFrame:
    """Distinct values of ``key`` over the rows where ``is_id`` holds."""
    return df.where(is_id).select(key).distinct()
