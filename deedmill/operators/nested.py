"""Nested arrays to rows and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def array_length(df: DataFrame, array: str) -> Column:
    """Elements of an array column; a NULL array has none.

    Elements that are structs are counted by their first field, so that the
    Parquet reader leaves the other fields alone.
    """
    column, element = F.col(array), df.schema[array].dataType.elementType
    if isinstance(element, T.StructType) and element.fields:
        column = column[element.fields[0].name]
    return F.coalesce(F.size(column), F.lit(0))


def flatten_counts(df: DataFrame, prefix: str, counts: Mapping[str, str]) -> DataFrame:
    """Drop the columns that start with ``prefix``; add array lengths as ``counts``."""
    keep = [F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix)]
    lengths = [
        (array_length(df, array) if array in df.columns else F.lit(0)).alias(name)
        for name, array in counts.items()
    ]
    return df.select(*keep, *lengths)


def explode_children(
    df: DataFrame,
    parent: str | Sequence[str],
    array: str,
    fields: Sequence[str],
    drop_empty: bool = False,
) -> DataFrame:
    """One row per array element: the parent id and the element's ``fields``.

    Parents without elements vanish, equal elements stay. An element that is
    NULL gives a row of NULLs; ``drop_empty`` removes rows without any value.
    """
    parents = [parent] if isinstance(parent, str) else list(parent)
    rows = df.select(*parents, F.explode(array).alias("_child")).select(
        *parents, *[F.col("_child")[name].alias(name) for name in fields]
    )
    return rows.dropna(how="all", subset=list(fields)) if drop_empty else rows
