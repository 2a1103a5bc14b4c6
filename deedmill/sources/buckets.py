"""Tables in hash buckets: a load rewrites the buckets of its own keys and no others.

A bucket is a folder of Parquet files that is never changed. Which folders make
up the table says a manifest, a small numbered file; the newest counts. A load
writes the buckets it touches anew, all in one job, and then the next manifest,
in which all other buckets keep their folders. Readers that have begun go on with
what their manifest named; a load that fails leaves folders nobody reads, which
the next one removes together with those of manifests too old to be in use.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from deedmill.operators.dedupe import first_per_key
from deedmill.operators.upsert import upsert
from deedmill.session import filesystem, staging
from deedmill.sources.snapshots import path_exists

#: Rows of a bucket that a table's first load aims at, and how few and how many buckets there are at all.
BUCKET_ROWS, FEWEST, MOST = 250_000, 8, 4096
BUCKET = "_bucket"
#: Manifests that stay for readers that have begun before the newest came.
KEPT_MANIFESTS = 3


class ManifestTaken(RuntimeError):
    """Another writer has published the version this one worked on."""


def _versions(spark: SparkSession, base: str) -> list[int]:
    place = f"{base}/manifest"
    if not path_exists(spark, place):
        return []
    fs, folder = filesystem(spark, place)
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n[1:9]) for n in names if n.startswith("v") and n.endswith(".json"))


def _manifest(spark: SparkSession, base: str, version: int) -> dict:
    fs, file = filesystem(spark, f"{base}/manifest/v{version:08d}.json")
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _publish(spark: SparkSession, base: str, version: int, manifest: dict) -> None:
    """Written aside and renamed, so that readers see all of it or nothing; a taken number is an error."""
    fs, draft = filesystem(spark, f"{base}/manifest/_{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(json.dumps(manifest).encode())
    finally:
        out.close()
    _, target = filesystem(spark, f"{base}/manifest/v{version:08d}.json")
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise ManifestTaken(f"version {version} of {base} is there already")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _read(spark: SparkSession, base: str, manifest: dict, buckets: Sequence[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    named = manifest["folders"] if buckets is None else {b: manifest["folders"][b] for b in buckets if b in manifest["folders"]}
    if not named:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/{folder}" for _, folder in sorted(named.items())])


def read_buckets(spark: SparkSession, base: str, of: DataFrame | None = None) -> DataFrame | None:
    """The table as last published, or its buckets that the keys ``of`` some rows fall in; None where there is none yet."""
    versions = _versions(spark, base)
    if not versions:
        return None
    manifest = _manifest(spark, base, versions[-1])
    return _read(spark, base, manifest, None if of is None else _buckets_of(of, manifest["keys"], manifest["buckets"]))


def _buckets_of(rows: DataFrame, keys: Sequence[str], buckets: int) -> list[str]:
    """Names of buckets: at most as many as the table has."""
    return sorted(str(r[0]) for r in rows.select(bucket_of(keys, buckets).alias("b")).distinct().collect())


Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def merge_buckets(
    source: DataFrame, base: str, keys: Sequence[str], merge: Merge, buckets: int | None = None, whole: bool = False
) -> int:
    """Let ``merge`` make the new rows of the touched buckets; returns the number of buckets written.

    ``merge`` gets what these buckets hold now (None while there is no table) and
    ``source``, worked out once, and returns all rows they are to hold. The
    number of buckets is that of the table's first load, by its rows unless given. An empty source writes
    nothing once there is a table. With ``whole`` the table is made anew: ``merge``
    gets None and buckets the source does not touch are dropped.
    """
    spark = source.sparkSession
    versions = _versions(spark, base)
    manifest = _manifest(spark, base, versions[-1]) if versions else {"buckets": buckets, "folders": {}}
    with staging(source, "bucket-load") as rows:
        if manifest["buckets"] is None:
            manifest["buckets"] = min(max(-(-rows.count() // BUCKET_ROWS), FEWEST), MOST)
        place = bucket_of(keys, manifest["buckets"])
        touched = _buckets_of(rows, keys, manifest["buckets"])
        if not touched and versions and not whole:
            return 0
        current = _read(spark, base, manifest, touched) if versions and not whole else None
        merged = merge(current, rows)
        folder = f"data/{uuid.uuid4().hex}"
        # a bucket is a file or a few: AQE splits one that is much larger than others
        merged.withColumn(BUCKET, place).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{base}/{folder}")
    fs, written = filesystem(spark, f"{base}/{folder}")
    found = [s.getPath().getName() for s in fs.listStatus(written)]
    fresh = {n.removeprefix(f"{BUCKET}="): f"{folder}/{n}" for n in found if n.startswith(f"{BUCKET}=")}
    kept = {} if whole else {b: f for b, f in manifest["folders"].items() if b not in set(touched)}
    number = (versions[-1] if versions else 0) + 1
    facts = {"buckets": manifest["buckets"], "keys": list(keys), "schema": merged.schema.jsonValue()}
    _publish(spark, base, number, {**facts, "folders": {**kept, **fresh}})
    _clear(spark, base, [*versions, number])
    return len(fresh)


def _clear(spark: SparkSession, base: str, versions: list[int]) -> None:
    """Remove manifests too old to be in use, and loads that no other one names."""
    used = set()
    for version in versions[-KEPT_MANIFESTS:]:
        used |= {folder.split("/")[1] for folder in _manifest(spark, base, version)["folders"].values()}
    for version in versions[:-KEPT_MANIFESTS]:
        fs, file = filesystem(spark, f"{base}/manifest/v{version:08d}.json")
        fs.delete(file, False)
    fs, data = filesystem(spark, f"{base}/data")
    if fs.exists(data):
        for status in fs.listStatus(data):
            if status.getPath().getName() not in used:
                fs.delete(status.getPath(), True)


def upsert_buckets(
    source: DataFrame,
    base: str,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    stamp: Column | None = None,
    buckets: int | None = None,
) -> int:
    """Insert or update ``source``; returns the number of buckets written. The rest is as in ``upsert``."""

    def merge(current: DataFrame | None, rows: DataFrame) -> DataFrame:
        if current is not None:
            return upsert(current, rows, keys, order, stamp)
        rows = first_per_key(rows, list(keys), order) if order else rows
        return rows if stamp is None else rows.withColumns({"created_at": stamp, "updated_at": stamp})

    return merge_buckets(source, base, keys, merge, buckets)
