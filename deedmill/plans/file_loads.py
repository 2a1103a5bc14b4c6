"""File loads: delimited files into tables, with required columns and one audit row per load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deedmill.operators.dedupe import latest_per_key
from deedmill.plans.audit import audit_row
from deedmill.plans.rollups import active_mapping, clean_loans, merge_snapshots
from deedmill.session import cleans_up
from deedmill.sources import files
from deedmill.sources.buckets import merge_buckets, read_buckets
from deedmill.sources.snapshots import read_partitions, read_snapshot, replace_partitions, upsert_snapshot, write_snapshot

SALE_ORDER = ("sale_date", "sale_price", "buyer", "seller")
VINTAGE = "vintage"
DEMOGRAPHIC_REQUIRED = ("geography_code", "geography_name", "geography_type", VINTAGE)
MAPPING_REQUIRED = ("property_id", "tax_assessor_id", "identifier", "zip", "active_flag")


@dataclass(frozen=True)
class Place:
    """Where loads go: a table per name under ``base``, audit rows under ``audit``."""

    base: str
    audit: str
    schema: str = "raw"


def _audited(spark: SparkSession, place: Place, name: str, write, insert_date: Column | None, read=read_snapshot) -> None:
    path = f"{place.base}/{name}"
    before = read(spark, path)
    if before is not None:
        # counted before the load: a partitioned table changes in place
        before = spark.range(before.count())
    write(path)
    after = read(spark, path)
    row = audit_row(after.limit(0) if before is None else before, after, name, place.schema, insert_date)
    row.write.mode("append").parquet(place.audit)


@cleans_up
def load_sales_job(spark: SparkSession, paths: str | list[str], place: Place, insert_date: Column | None = None) -> None:
    """Sales files: the newest sale per property is inserted or updated."""
    sales = files.require_columns(files.read_sales(spark, paths), ["property_id", *SALE_ORDER])
    order = [F.desc_nulls_last(c) for c in SALE_ORDER]
    write = lambda path: upsert_snapshot(sales, path, ["property_id"], order)
    _audited(spark, place, "sales", write, insert_date)


@cleans_up
def load_loans_job(
    spark: SparkSession, paths: str | list[str], place: Place, tiebreak: Sequence[str], insert_date: Column | None = None
) -> None:
    """Loan files: cleaned, the table replaced."""
    loans = clean_loans(files.read_loans(spark, paths), tiebreak)
    _audited(spark, place, "loans", lambda path: write_snapshot(loans, path), insert_date)


@cleans_up
def load_series_job(spark: SparkSession, paths: str | list[str], place: Place, insert_date: Column | None = None) -> None:
    """Series files: the known series, the table replaced."""
    series = files.read_series(spark, paths)
    _audited(spark, place, "series", lambda path: write_snapshot(series, path), insert_date)


@cleans_up
def load_mapping_job(spark: SparkSession, paths: str | list[str], place: Place, insert_date: Column | None = None) -> None:
    """Mapping files: required columns, then the active rows with their derived property id."""
    mapping = files.require_columns(files.read_mapping(spark, paths), MAPPING_REQUIRED)
    _audited(spark, place, "mapping", lambda path: write_snapshot(active_mapping(mapping), path), insert_date)


@cleans_up
def load_properties_job(
    spark: SparkSession, paths: dict[str, str], place: Place, insert_date: Column | None = None
) -> None:
    """Monthly property files, ``{month: path}``: per property the row of its latest month, whenever that comes.

    Files of several months may come together, and older ones later. Of two rows
    of one property and month the one loaded last stays. Only the buckets of the
    properties in the files are rewritten.
    """
    rows = files.clean_snapshot(files.read_snapshot_files(spark, paths)).where(F.col("property_id").isNotNull())
    newest = merge_snapshots(rows, "property_id", "snapshot_month", [c for c in rows.columns if c != "snapshot_month"])

    def merge(current: DataFrame | None, load: DataFrame) -> DataFrame:
        if current is None:
            return load
        both = current.withColumn("_new", F.lit(0)).unionByName(load.withColumn("_new", F.lit(1)))
        return latest_per_key(both, ["property_id"], "snapshot_month", [F.desc("_new")]).drop("_new")

    write = lambda path: merge_buckets(newest, path, ["property_id"], merge)
    _audited(spark, place, "properties", write, insert_date, read_buckets)


@cleans_up
def load_demographics_job(spark: SparkSession, paths: str | list[str], place: Place, insert_date: Column | None = None) -> None:
    """Demographics files: required columns, any number of measures; the vintages in the files replace those in the table."""
    rows = files.read_demographics(spark, paths, DEMOGRAPHIC_REQUIRED)
    write = lambda path: replace_partitions(rows, path, [VINTAGE], VINTAGE)
    _audited(spark, place, "demographics", write, insert_date, lambda s, path: read_partitions(s, path, VINTAGE))
