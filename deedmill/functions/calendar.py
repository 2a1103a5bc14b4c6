"""Days and months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def default_window(
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    as_of: dt.date | str | None = None,
) -> tuple[Column, Column]:
    """First and last day to load: yesterday to today unless given."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    first = F.date_sub(today, 1) if not start else F.lit(start).cast("date")
    last = today if not end else F.lit(end).cast("date")
    return first, last


def valid_month(text: Column) -> Column:
    """Is the text a month written YYYY-MM, zero-padded?"""
    shape = text.rlike(r"\A[0-9]{4}-(0[1-9]|1[0-2])\z") & ~text.startswith("0000")
    return F.coalesce(shape, F.lit(False))


def month_start(month: Column) -> Column:
    return F.to_date(F.concat(month, F.lit("-01")))


def month_end(month: Column) -> Column:
    return F.last_day(month_start(month))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def months_between_keys(start: Column, end: Column) -> Column:
    """Array of the months from ``start`` to ``end``, both in; NULL when reversed."""
    first, last = month_start(start), month_start(end)
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return F.transform(days, month_of)


def month_series(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per month key, with its first and last day."""
    keys = spark.range(1).select(
        F.explode(months_between_keys(F.lit(start), F.lit(end))).alias("month")
    )
    return with_month_bounds(keys)


def with_month_bounds(months: DataFrame, month: str = "month") -> DataFrame:
    return months.withColumns(
        {"start_date": month_start(F.col(month)), "end_date": month_end(F.col(month))}
    )
