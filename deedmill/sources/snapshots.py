"""Model tables as whole snapshots, and partition-wise updates.

Parquet has no MERGE, and a path that is being read cannot be overwritten. A
table is therefore a folder of numbered snapshots of which the newest complete
one counts; writing one never disturbs readers, and a failed write leaves no
trace in what they see.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from deedmill.operators.dedupe import first_per_key
from deedmill.operators.upsert import upsert
from deedmill.session import filesystem, staging

_WRITTEN = "_written"
#: Snapshots that stay for readers that have begun before the newest came.
KEPT_SNAPSHOTS = 3


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = filesystem(spark, path)
    return fs.exists(folder)


def _complete_snapshots(spark: SparkSession, base: str) -> list[int]:
    if not path_exists(spark, base):
        return []
    fs, folder = filesystem(spark, base)
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    numbered = [n for n in names if n.startswith("v") and n[1:].isdigit()]
    return sorted(int(n[1:]) for n in numbered if path_exists(spark, f"{base}/{n}/_SUCCESS"))


def read_snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest complete snapshot; None where there is none yet."""
    versions = _complete_snapshots(spark, base)
    return spark.read.parquet(f"{base}/v{versions[-1]:08d}") if versions else None


def write_snapshot(
    df: DataFrame, base: str, partition_by: Sequence[str] = (), counted: Column | None = None
) -> int:
    """Write the next snapshot; returns its rows (or the ``counted`` ones), observed while writing."""
    versions = _complete_snapshots(df.sparkSession, base)
    target = f"{base}/v{(versions[-1] if versions else 0) + 1:08d}"
    seen = Observation("snapshot")
    rows = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    df = df.observe(seen, rows.alias("rows")).drop(_WRITTEN)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    for old in versions[: 1 - KEPT_SNAPSHOTS]:
        fs, folder = filesystem(df.sparkSession, f"{base}/v{old:08d}")
        fs.delete(folder, True)
    return int(seen.get["rows"])


def upsert_snapshot(
    source: DataFrame,
    base: str,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    stamp: Column | None = None,
) -> int:
    """Insert or update ``source`` into a snapshot table; returns the rows inserted or updated.

    The source is worked out once and staged, as the upsert reads it several
    times; its true size then also decides whether it is broadcast.
    """
    current = read_snapshot(source.sparkSession, base)
    if current is None:
        rows = first_per_key(source, keys, order) if order else source
        if stamp is not None:
            rows = rows.withColumns({"created_at": stamp, "updated_at": stamp})
        return write_snapshot(rows, base)
    written = F.coalesce(F.col(_WRITTEN), F.lit(False))
    with staging(source, "upsert") as rows:
        marked = rows.withColumn(_WRITTEN, F.lit(True))
        return write_snapshot(upsert(current, marked, keys, order, stamp), base, counted=written)


def read_partitions(spark: SparkSession, path: str, partition: str) -> DataFrame | None:
    """A partitioned table; None where there is none. Folder names stay text."""
    if not path_exists(spark, path):
        return None
    fields = spark.read.parquet(path).schema.fields
    text = T.StructField(partition, T.StringType())
    schema = T.StructType([text if f.name == partition else f for f in fields])
    return spark.read.schema(schema).parquet(path)


def upsert_partitions(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: str,
    order: Sequence[Column] = (),
    stamp: Column | None = None,
) -> int:
    """Upsert into a table partitioned by a text column, rewriting only what is touched.

    For large facts: a day's load rewrites a few months, not the table. Touched
    are the partitions of the source's rows and those that hold older versions
    of them; their names are a short list, so only those folders are read in
    full. A partition that ends up empty is removed after the others are written.
    Returns the rows inserted or updated.
    """
    keys = list(keys)
    once = first_per_key(source, keys, order) if order else source
    target = read_partitions(source.sparkSession, path, partition)
    with staging(once, "upsert") as rows:
        if target is None:
            fresh = rows if stamp is None else rows.withColumns({"created_at": stamp, "updated_at": stamp})
            _overwrite_partitions(fresh, path, partition)
        else:
            _merge_partitions(target, rows, path, keys, partition, stamp)
        return rows.count()


def replace_partitions(source: DataFrame, path: str, groups: Sequence[str], partition: str, whole: bool = False) -> None:
    """Replace groups of rows (all those with the same ``groups``) in a table partitioned by a text column.

    Partitions that hold rows of these groups, before or after, are rewritten and
    no others. With ``whole`` the source is all there is to be: partitions that
    it does not have are removed.
    """
    target = read_partitions(source.sparkSession, path, partition)
    if target is None or (list(groups) == [partition] and not whole):
        _overwrite_partitions(source, path, partition)
    elif not whole:
        _merge_partitions(target, source, path, list(groups), partition, None)
    else:
        names = [r[0] for r in source.select(partition).distinct().collect()]
        gone = _folders(target.where(~_is_any(partition, names))) if names else _folders(target)
        _overwrite_partitions(source, path, partition)
        for folder in gone:
            fs, place = filesystem(source.sparkSession, folder)
            fs.delete(place, True)


def _merge_partitions(
    target: DataFrame,
    rows: DataFrame,
    path: str,
    keys: list[str],
    partition: str,
    stamp: Column | None,
) -> None:
    old = target.select(*keys, F.col(partition).alias("_old")).join(rows.select(*keys, partition), keys)
    # one name for each partition
    wanted = old.select(F.col("_old").alias(partition)).union(rows.select(partition)).distinct()
    names = [r[0] for r in wanted.collect()]
    touched = target.where(_is_any(partition, names))
    # partitions of the table are replaced while it is read, so the result comes first
    with staging(upsert(touched, rows, keys, stamp=stamp), "merged") as merged:
        left = {r[0] for r in merged.select(partition).distinct().collect()}
        emptied = _folders(touched.where(_is_any(partition, [n for n in names if n not in left])))
        _overwrite_partitions(merged, path, partition)
    for folder in emptied:
        fs, place = filesystem(target.sparkSession, folder)
        fs.delete(place, True)


def _is_any(column: str, values: list) -> Column:
    """``column`` in ``values``, NULL among them if it is; folders of others are not read."""
    named = F.col(column).isin([v for v in values if v is not None])
    return named | F.col(column).isNull() if None in values else named


def _folders(rows: DataFrame) -> list[str]:
    """The folders of the files that hold ``rows``: one for each partition."""
    file = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    jvm = rows.sparkSession.sparkContext._jvm
    found = rows.select(file.alias("folder")).distinct().collect()
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r[0])).toString() for r in found]


def _overwrite_partitions(rows: DataFrame, path: str, partition: str) -> None:
    # few files per partition; AQE splits a partition that is much larger than others
    (
        rows.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
