"""Delimited files of property masters, loans, sales, series and mappings.

Schemas are given, never inferred, and every value is read as text and cleaned
by expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from deedmill import schemas
from deedmill.functions.cleaning import clean_date, clean_int, clean_number

# --- fixed values ------------------------------------------------------------
RENT, OCCUPANCY = "Rent Actual", "Occupancy Rate"
SERIES = [RENT, OCCUPANCY]
# --- end of fixed values -----------------------------------------------------


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_snapshot_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Monthly property files, ``{month: path}``, each row tagged with its month."""
    parts = [
        read_csv(spark, path, schemas.SNAPSHOT_PROPERTY).withColumn("snapshot_month", F.lit(month))
        for month, path in sorted(paths.items())
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def read_loans(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, schemas.LOAN_FILE)
    return df.withColumns(
        {
            "loan_origination_date": clean_date(F.col("loan_origination_date")),
            "loan_maturity_date": clean_date(F.col("loan_maturity_date")),
        }
    )


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, schemas.SALE_FILE)
    return df.withColumns(
        {
            "sale_date": clean_date(F.col("sale_date")),
            "sale_price": clean_number(F.col("sale_price")).try_cast(schemas.MONEY),
        }
    )


def read_series(spark: SparkSession, path: str, series: Sequence[str] = tuple(SERIES)) -> DataFrame:
    df = read_csv(spark, path, schemas.SERIES_FILE)
    return load_series(df, series).withColumns(
        {
            "record_date": clean_date(F.col("record_date")),
            "record_values": F.col("record_values").try_cast("double"),
        }
    )


def load_series(df: DataFrame, series: Sequence[str] = tuple(SERIES)) -> DataFrame:
    return df.where(F.col("series").isin(list(series)))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.MAPPING_FILE).withColumn(
        "insert_date", clean_date(F.col("insert_date"))
    )


def read_demographics(spark: SparkSession, path: str | list[str], required: Sequence[str]) -> DataFrame:
    """Demographics by area: the ``required`` columns as text, all others as numbers."""
    df = require_columns(spark.read.csv(path, header=True, inferSchema=False, mode="FAILFAST"), required)
    measures = [c for c in df.columns if c not in required]
    return df.select(*required, *[clean_number(F.col(f"`{c}`")).alias(c) for c in measures])


def clean_snapshot(df: DataFrame) -> DataFrame:
    """Typed columns of the property master."""
    return df.withColumns(
        {
            "units": clean_int(F.col("units")),
            "sqft": clean_int(F.col("sqft")),
            "completion_date": clean_date(F.col("completion_date")),
            "latitude": F.col("latitude").try_cast("double"),
            "longitude": F.col("longitude").try_cast("double"),
        }
    )
