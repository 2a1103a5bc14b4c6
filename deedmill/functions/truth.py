"""Truth of loosely typed values.

The rule is the one of a dynamic language: NULL, empty text, zero and false are
false, everything else is true, so the texts ``"N"`` and ``"0"`` count as true.
``yes_flag`` is the stricter reading for feeds that send Y/N texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def truthy_text(value: Column) -> Column:
    return F.coalesce(value != "", F.lit(False))


def truthy_number(value: Column) -> Column:
    return F.coalesce(value != 0, F.lit(False))


def truthy_bool(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def truthy_any(value: Column) -> Column:
    """For dates, timestamps and other types where only NULL is false."""
    return value.isNotNull()


def truthy(df: DataFrame, name: str) -> Column:
    """Truth of column ``name``, by its type in ``df``."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return truthy_text(df[name])
    if isinstance(kind, T.BooleanType):
        return truthy_bool(df[name])
    if isinstance(kind, T.NumericType):
        return truthy_number(df[name])
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(df[name]) > 0, F.lit(False))
    return truthy_any(df[name])


# --- fixed values: texts read as "no" by yes_flag ----------------------------
NO_TEXTS = ["", "n", "no", "f", "false", "0"]
# --- end of fixed values -----------------------------------------------------


def yes_flag(value: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(value)).isin(NO_TEXTS), F.lit(False))


def flag(value: Column, mode: str = "python") -> Column:
    """A text flag as boolean; ``mode`` is ``"python"`` or ``"yn"``."""
    if mode == "python":
        return truthy_text(value)
    if mode == "yn":
        return yes_flag(value)
    raise ValueError(f"unknown flag mode: {mode}")


def filled(value: Column) -> Column:
    """Empty text as NULL, so that ``coalesce`` falls through it."""
    return F.nullif(value, F.lit(""))
