"""Counts, shares and set sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    """One row, column ``n``: distinct values of the columns, NULL being a value.

    One distinct per aggregate keeps Spark from expanding every row once per
    distinct column; duplicates collapse on the map side.
    """
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count))


def share_of_total(
    df: DataFrame, column: str, missing: str | None = None, count: str = "n", pct: str = "pct"
) -> DataFrame:
    """Rows per value and their percentage of all rows."""
    if missing is not None:
        df = df.withColumn(column, F.coalesce(F.col(column), F.lit(missing)))
    counts = histogram(df, column, count)
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(pct, F.col(count).cast("double") / total.cast("double") * 100)


def most_common(counts: DataFrame, keys: Sequence[str], value: str, count: str) -> DataFrame:
    """The most frequent value per key from (key, value, count) rows; ties: the lowest."""
    best = F.min_by(F.col(value), F.struct(-F.col(count), F.col(value)))
    return counts.where(F.col(value).isNotNull()).groupBy(*keys).agg(best.alias(value))
