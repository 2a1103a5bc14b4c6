"""Size checks before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame

_UNITS = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40, "p": 2**50}


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def threshold_bytes(text: str) -> int:
    """A size as Spark's settings write it: ``10485760``, ``256k``, ``10mb``, ``-1``."""
    digits = text.strip().lower().removesuffix("b")
    unit = _UNITS.get(digits[-1:], 1)
    return int(digits.rstrip("".join(_UNITS))) * unit


def catalyst_will_broadcast(df: DataFrame) -> bool:
    """Is the estimate within the session's own broadcast threshold?"""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    return 0 <= estimated_bytes(df) <= threshold_bytes(limit)
