"""Compare a Spark result with the rows of its SQL check."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def tables(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def difference(df, con, sql: str, show: int = 3) -> str | None:
    """None when columns, rows and values agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(columns)}"
    order = sorted(columns)
    expected = Counter(
        tuple(_plain(v) for _, v in sorted(zip(columns, row), key=lambda p: p[0])) for row in result.fetchall()
    )
    actual = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; columns {order}; "
        f"only in Spark {sum(extra.values())}: {list(extra)[:show]}; "
        f"only in SQL {sum(missing.values())}: {list(missing)[:show]}"
    )
