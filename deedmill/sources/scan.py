"""Bounded reads. Filters and column lists reach the Parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from deedmill.operators.keys import dense_index

SHALLOW_ROWS = 100_000


def scan_table(
    spark: SparkSession,
    path: str,
    columns: str | Sequence[str] = "*",
    filters: Mapping[str, Any] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Columns of a table, AND of equality filters, optional limit (0 is none)."""
    df = spark.read.parquet(path)
    if filters:
        df = df.where(reduce(Column.__and__, [F.col(c) == v for c, v in filters.items()]))
    if columns != "*":
        names = [c.strip() for c in columns.split(",")] if isinstance(columns, str) else columns
        df = df.select(*names)
    return df.limit(limit) if limit else df


def days_between(df: DataFrame, column: str, start: Any, end: Any) -> Column:
    """``start <= day of column <= end``, written so that the scan can use it.

    A cast around a timestamp column would keep the filter out of the scan, so
    the bounds take the column's type instead.
    """
    as_day = [b if isinstance(b, Column) else F.lit(b).cast("date") for b in (start, end)]
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        first, after = as_day[0], F.date_add(as_day[1], 1)
        return (value >= first.cast(kind)) & (value < after.cast(kind))
    if isinstance(kind, T.StringType):
        first, last = (F.date_format(b, "yyyy-MM-dd") for b in as_day)
        return value.between(first, last)
    return value.between(*as_day)


def scan_date_range(
    df: DataFrame,
    column: str,
    start: dt.date | str | Column,
    end: dt.date | str | Column,
    drop_prefix: str | None = None,
) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both in.

    ``drop_prefix`` leaves out the nested columns of that prefix, which the
    Parquet reader then never touches. Rows are in no order; sort to present.
    """
    rows = df.where(days_between(df, column, start, end))
    if drop_prefix is None:
        return rows
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(drop_prefix)])


def page_slice(
    df: DataFrame,
    order: Sequence[str],
    page_size: int,
    page: int = 0,
    max_records: int | None = None,
    shallow_rows: int = SHALLOW_ROWS,
) -> DataFrame:
    """Page ``page`` (from 0) of ``df`` in ``order``, which must be total.

    ``max_records`` caps all pages together. NULLs come first. Early pages are a
    top-k. For late ones whole rows are numbered in parallel, as a top-k would
    bring all rows before the page to one task; the rows of a page are the same.
    """
    skip = page * page_size
    take = page_size if max_records is None else max(0, min(page_size, max_records - skip))
    if skip + take <= shallow_rows:
        return df.orderBy(*order).offset(skip).limit(take)
    numbered = dense_index(df, order, "_row")
    return numbered.where(F.col("_row").between(skip + 1, skip + take)).drop("_row").orderBy(*order)


def capped(df: DataFrame, order: Sequence[str], max_records: int | None) -> DataFrame:
    """The first ``max_records`` rows in ``order``; None or 0 is no cap."""
    return df.orderBy(*order).limit(max_records) if max_records else df
