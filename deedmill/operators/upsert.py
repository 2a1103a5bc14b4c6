"""Insert-or-update as a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.operators.dedupe import first_per_key


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    stamp: Column | None = None,
) -> DataFrame:
    """``target`` after inserting or updating the rows of ``source``.

    Of several source rows with one key the first in ``order`` is taken; without
    ``order`` keys must be unique. Columns the source lacks keep the target's
    values. With ``stamp``, ``created_at`` is set on insert and ``updated_at``
    on every write. Target rows are only ever filtered, so a small source is
    broadcast and the target is not shuffled.
    """
    keys = list(keys)
    incoming = first_per_key(source, keys, order) if order else source
    if stamp is not None:
        incoming = incoming.withColumn("updated_at", stamp)
    carried = [c for c in target.columns if c not in incoming.columns]
    if carried:
        old = target.select(*keys, *carried).join(incoming.select(*keys), keys, "left_semi")
        incoming = incoming.join(old, keys, "left")
    if stamp is not None and "created_at" in target.columns:
        incoming = incoming.withColumn("created_at", F.coalesce("created_at", stamp))
    kept = target.join(incoming.select(*keys), keys, "left_anti")
    extra = [c for c in incoming.columns if c not in target.columns]
    return kept.unionByName(incoming, allowMissingColumns=True).select(*target.columns, *extra)
