"""Lookups, semi and anti joins, key membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.operators.dedupe import latest_per_key


def keyed_rows(
    df: DataFrame,
    ids: DataFrame,
    key: str,
    code: str | None = None,
    codes: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is among ``ids``, optionally with a code in a list."""
    if code is not None and codes is not None:
        df = df.where(F.col(code).isin(list(codes)))
    return df.join(ids.select(key), key, "left_semi")


def unique_lookup(
    dim: DataFrame,
    key: str,
    value: str,
    is_key: Column,
    current: str | None = None,
    ts: str | None = None,
) -> DataFrame:
    """Build side of a lookup: one (key, value) row per key.

    Only current rows count where a current flag is given. Of several rows the
    newest wins, then the highest value.
    """
    rows = dim.where(is_key)
    if current is not None:
        rows = rows.where(F.col(current))
    if ts is None:
        return rows.groupBy(key).agg(F.max(value).alias(value))
    return latest_per_key(rows.select(key, value, ts), [key], ts, [F.desc(value)]).select(key, value)


def fk_counts(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One row: child rows whose ``fk`` is a parent key, and all child rows.

    Child rows are counted per key first, so the join sees one row per key
    however often a key occurs. A NULL key matches a NULL parent key, as set
    membership does.
    """
    counts = child.groupBy(F.struct(F.col(fk).alias("k")).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    parents = parent.select(F.struct(F.col(pk).alias("k")).alias("_key"), F.lit(True).alias("_found"))
    joined = counts.join(parents.distinct(), "_key", "left")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col("_found"), F.col("_rows"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
    )


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work units not done yet, in order."""
    return work.join(done.select(key), key, "left_anti").orderBy(key)
