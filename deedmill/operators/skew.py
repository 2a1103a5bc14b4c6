"""Hot keys: finding them and joining around them.

A key may hold a third of all rows. Joins here keep such keys out of the hash
shuffle; the hot set is bounded by construction, so it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.operators.sizing import catalyst_will_broadcast
from deedmill.session import freeze, staged

MAX_HOT_KEYS = 1000
HOT_MIN_ROWS = 1_000_000
SPREAD = 2048


def hot_keys(
    df: DataFrame,
    key: str,
    max_keys: int = MAX_HOT_KEYS,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Keys with more than 1/``max_keys`` of the rows: fewer than ``max_keys`` of them.

    The counts combine on the map side, so finding a hot key moves one row per
    key and task.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(
        (F.col("_rows") >= min_rows) & (F.col("_rows") * max_keys > total)
    ).select(key)


def _found_hot(df: DataFrame, key: str, max_keys: int, min_rows: int) -> DataFrame | None:
    """Hot keys worked out now and kept, so that a chain of lookups does not
    repeat its own beginning inside every count; None where there are none."""
    hot = freeze(hot_keys(df.select(key), key, max_keys, min_rows))
    return None if hot.isEmpty() else hot


def settled(df: DataFrame, dim: DataFrame, name: str) -> DataFrame:
    """``df`` as it is if ``dim`` will be broadcast to it, else written once: a lookup
    then counts keys first, and what made ``df`` would run for that as well."""
    return df if catalyst_will_broadcast(dim) else staged(df, name)


def lookup_left(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Sequence[str],
    is_key: Column,
    spread_by: Column,
    counted: DataFrame | None = None,
    max_keys: int = MAX_HOT_KEYS,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Left equi-join adding ``columns`` of ``dim``, which holds one row per ``key``.

    Rows whose key is no key (``is_key`` false) match nothing and get NULLs; the
    row count never changes. When Catalyst will not broadcast ``dim``, rows with
    a hot key take their columns from a broadcast of the few hot ``dim`` rows,
    and both they and the keyless rows are spread over the shuffle by a hash of
    ``spread_by`` (any column that tells rows apart) to a slot ``dim`` never has.
    ``counted`` may name a cheaper frame with the keys of ``df``.
    """
    lookup = dim.select(F.col(key).alias("_key"), *columns)
    keyed = df.withColumn("_key", F.when(is_key, F.col(key)))
    if catalyst_will_broadcast(lookup):
        return keyed.join(lookup, "_key", "left").drop("_key")

    keys = keyed.select("_key") if counted is None else counted.select(F.col(key).alias("_key"))
    hot = _found_hot(keys, "_key", max_keys, min_rows)
    aside = F.col("_key").isNull()
    values = F.struct(*[F.col(c) for c in columns])
    if hot is not None:
        # bounded: fewer than max_keys rows on either side
        matched = lookup.join(F.broadcast(hot), "_key", "left_semi")
        hot_dim = hot.join(F.broadcast(matched), "_key", "left").select(
            "_key", values.alias("_hot_values"), F.lit(True).alias("_hot")
        )
        keyed = keyed.join(F.broadcast(hot_dim), "_key", "left")
        aside = aside | F.coalesce(F.col("_hot"), F.lit(False))
    slot = F.when(aside, 1 + F.pmod(F.xxhash64(spread_by), F.lit(SPREAD))).otherwise(0)
    place = lambda k, n: F.struct(k.alias("key"), n.cast("long").alias("slot"))
    # one struct as key: a constant slot beside the key would be taken out of the
    # hash as a mere filter on the left side, and nothing would be spread
    cold = lookup.select(place(F.col("_key"), F.lit(0)).alias("_place"), values.alias("_values"))
    joined = keyed.withColumn("_place", place(F.col("_key"), slot)).join(
        cold, "_place", "left"
    )
    found = F.col("_values")
    if hot is not None:
        found = F.when(F.col("_hot"), F.col("_hot_values")).otherwise(found)
    return joined.select(*df.columns, *[found[c].alias(c) for c in columns])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    salts: int = 200,
    max_keys: int = MAX_HOT_KEYS,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Inner or left equi-join that splits the hot keys of ``left``.

    Left rows with a hot key go to one of ``salts`` shares by a hash of
    ``spread_by``; the right rows of those keys, and only those, are repeated
    for every share. ``right`` may hold several rows per key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if catalyst_will_broadcast(right):
        return left.join(right, key, how)
    if how == "inner":
        left = left.where(F.col(key).isNotNull())
    hot = _found_hot(left, key, max_keys, min_rows)
    if hot is None and how == "inner":
        return left.join(right, key)
    is_hot = F.lit(False)
    if hot is not None:
        # bounded: fewer than max_keys rows
        marks = F.broadcast(hot.withColumn("_hot", F.lit(True)))
        left, right = (side.join(marks, key, "left") for side in (left, right))
        is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    share = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    shares = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), share).otherwise(0))
    repeated = right.withColumn("_salt", F.explode(shares))
    return dealt.drop("_hot").join(repeated.drop("_hot"), [key, "_salt"], how).drop("_salt")
