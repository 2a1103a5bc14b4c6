"""Pages of a table by position, from files that lie in the pages' order.

A table is stored once in a total order, cut into ranges of about one size, with
an index of how many rows each file holds. Where a page lies follows from the
index, so that it costs the one or two files it is in, however late it comes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from deedmill.session import freeze

ROWS_PER_FILE = 1_000_000
RANGE = "_range"


def write_pages(df: DataFrame, order: Sequence[str], path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Store ``df`` in ``order``, which must be total, NULLs first; returns its rows.

    Ranges come from a sample, so files differ in size; the index holds their true counts.
    """
    rows = freeze(df)
    total = rows.count()
    files = max(1, -(-total // rows_per_file))
    placed = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    # the number of the range is a folder, by which readers leave files out
    placed.withColumn(RANGE, F.spark_partition_id()).write.partitionBy(RANGE).parquet(f"{path}/rows")
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(), list(order))], "schema string, by array<string>").coalesce(1).write.parquet(f"{path}/head")
    counts = _stored(spark, path).groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows"))
    # one row for each file
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    index = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    index.write.parquet(f"{path}/index")
    return total


def _head(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    schema, by = spark.read.schema("schema string, by array<string>").parquet(f"{path}/head").first()
    return T.StructType.fromJson(json.loads(schema)), list(by)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    schema, _ = _head(spark, path)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(f"{path}/rows")


def _rows_between(spark: SparkSession, path: str, first: int, after: int) -> DataFrame:
    """Rows from position ``first`` up to ``after`` (from 0), out of the files that hold them."""
    _, by = _head(spark, path)
    stored = _stored(spark, path)
    index = spark.read.schema(f"{RANGE} int, rows long, before long").parquet(f"{path}/index")
    # a row for each file that is wanted, or two
    hit = index.where((F.col("before") < after) & (F.col("before") + F.col("rows") > first)).orderBy(RANGE).collect()
    if not hit or first >= after:
        return stored.drop(RANGE).limit(0)
    inner = [r[RANGE] for r in hit if r["before"] >= first and r["before"] + r["rows"] <= after]
    parts = [stored.where(F.col(RANGE).isin(inner))] if inner else []
    for r in hit:
        if r[RANGE] not in inner:
            # a file at an end of what is wanted: its rows from the one position to the other
            start, stop = max(first - r["before"], 0), min(after - r["before"], r["rows"])
            parts.append(stored.where(F.col(RANGE) == r[RANGE]).orderBy(*by).offset(start).limit(stop - start))
    return reduce(DataFrame.unionByName, parts).drop(RANGE)


def read_page(spark: SparkSession, path: str, page_size: int, page: int = 0, max_records: int | None = None) -> DataFrame:
    """Page ``page`` (from 0), in order; ``max_records`` caps all pages together."""
    first = page * page_size
    after = first + page_size if max_records is None else min(first + page_size, max_records)
    return _rows_between(spark, path, first, after).orderBy(*_head(spark, path)[1])


def read_first(spark: SparkSession, path: str, max_records: int | None) -> DataFrame:
    """The first ``max_records`` rows, in no order; None or 0 is no cap.

    Whole files but for the last, which alone is sorted and cut: no task holds
    more than a file, however high the cap.
    """
    if not max_records:
        return _stored(spark, path).drop(RANGE)
    return _rows_between(spark, path, 0, max_records)
