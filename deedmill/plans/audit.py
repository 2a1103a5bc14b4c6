"""Load audit and load log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deedmill.sources.snapshots import path_exists

# --- fixed values ------------------------------------------------------------
OK, FAILED = "ok", "failed"
LOG_SCHEMA = "month string, status string, rows long, error string, logged_at timestamp"
# --- end of fixed values -----------------------------------------------------


def audit_row(
    before: DataFrame, after: DataFrame, table: str, schema: str, insert_date: Column | None = None
) -> DataFrame:
    """Row counts of a table before and after a load."""
    rows = F.count(F.lit(1))
    when = F.current_date() if insert_date is None else insert_date
    return (
        after.agg(rows.alias("after_count"))
        .withColumn("before_count", before.agg(rows).scalar())
        .select(
            F.lit(table).alias("table_name"),
            F.lit(schema).alias("schema_name"),
            when.alias("insert_date"),
            "before_count",
            "after_count",
            (F.col("after_count") - F.col("before_count")).alias("new_rows"),
        )
    )


def load_state(log: DataFrame) -> DataFrame:
    """State per month: completed once any try was ok, else the newest try's status.

    The log only grows; a later failure does not undo a completed month, a later
    success clears a failed one.
    """
    done = F.count_if(F.col("status") == OK) > 0
    newest = F.max_by("status", "logged_at")
    return log.groupBy("month").agg(
        F.when(done, F.lit("completed")).otherwise(newest).alias("state"),
        F.count(F.lit(1)).alias("tries"),
        F.max_by("rows", F.when(F.col("status") == OK, F.col("logged_at"))).alias("rows"),
    )


def completed_months(log: DataFrame) -> DataFrame:
    return load_state(log).where(F.col("state") == "completed").select("month")


def failed_months(log: DataFrame) -> DataFrame:
    return load_state(log).where(F.col("state") == FAILED).select("month")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log at ``path``; an empty one where nothing was logged yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def load_summary(counts: dict[str, int]) -> dict:
    """Counts per table and their total."""
    return {"counts": dict(counts), "total": sum(counts.values())}
