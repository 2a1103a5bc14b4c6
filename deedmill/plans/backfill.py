"""Backfill of a month range: resumable, one job for all pending months."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from deedmill.functions.calendar import month_of, month_series
from deedmill.functions.deals import USE_CODES
from deedmill.operators.joins import pending
from deedmill.plans.audit import FAILED, LOG_SCHEMA, OK, completed_months, read_log
from deedmill.plans.extract import RAW_TABLES, raw_loads
from deedmill.schemas import Feed
from deedmill.session import cleans_up
from deedmill.sources.raw import read_raw, replace_batches
from deedmill.sources.scan import days_between
from deedmill.sources.snapshots import path_exists


def pending_months(spark: SparkSession, start: str, end: str, log: DataFrame) -> DataFrame:
    return pending(month_series(spark, start, end), completed_months(log), "month")


def month_frames(
    source: DataFrame,
    properties: DataFrame,
    feed: Feed,
    months: Sequence[str],
    codes: Sequence[str] | None = USE_CODES,
) -> dict[str, DataFrame]:
    """The raw loads of the months, each row tagged with its month as ``batch``."""
    first, last = min(months), max(months)
    # the day range reaches the scan; the month list takes out months in between
    wanted = days_between(
        source, "document_recorded_date", f"{first}-01", F.last_day(F.lit(f"{last}-01").cast("date"))
    )
    month = month_of(F.col("document_recorded_date").cast("date"))
    nested = source.where(wanted).withColumn("batch", month).where(F.col("batch").isin(list(months)))
    return raw_loads(nested, properties, feed, F.current_timestamp(), codes, ["batch"])


def log_months(spark: SparkSession, path: str, rows: Sequence[tuple[str, str, int | None, str | None]]) -> None:
    """Append one line per month: (month, status, rows, error)."""
    lines = [(*row, None) for row in rows]
    (
        spark.createDataFrame(lines, LOG_SCHEMA)
        .withColumn("logged_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .parquet(path)
    )


def _load(frames: dict[str, DataFrame], base: str, months: Sequence[str]) -> dict[str, int]:
    """Replace the months in the raw tables; returns rows per month over all tables."""
    spark = next(iter(frames.values())).sparkSession
    for table, frame in frames.items():
        replace_batches(frame, f"{base}/{table}")
    counts = dict.fromkeys(months, 0)
    for table in frames:
        if not path_exists(spark, f"{base}/{table}"):
            continue
        batches = read_raw(spark, f"{base}/{table}", RAW_TABLES[table]).where(F.col("batch").isin(list(months)))
        # one row per month
        for month, rows in batches.groupBy("batch").count().collect():
            counts[month] += rows
    return counts


Line = tuple[str, str, int | None, str | None]


def _settle(months: Sequence[str], attempt: Callable[[Sequence[str]], dict[str, int]], stop_on_error: bool) -> list[Line]:
    """Load ``months``, by halves where they fail together: a line per month, in order, up to the first bad one if asked."""
    try:
        return [(m, OK, n, None) for m, n in attempt(months).items()]
    except Exception as error:
        if len(months) == 1:
            return [(months[0], FAILED, None, str(error))]
    half = len(months) // 2
    lines = _settle(months[:half], attempt, stop_on_error)
    if stop_on_error and any(line[1] == FAILED for line in lines):
        return lines
    return lines + _settle(months[half:], attempt, stop_on_error)


@cleans_up
def backfill_job(
    source: DataFrame,
    properties: DataFrame,
    base: str,
    log_path: str,
    feed: Feed,
    start: str,
    end: str,
    transform: Callable[[], object] | None = None,
    stop_on_error: bool = False,
    codes: Sequence[str] | None = USE_CODES,
) -> dict:
    """Load every month of the range that no earlier run completed.

    All pending months go through one job; loading a month again replaces it.
    Only if that job fails are its halves tried, and so on down to the bad
    months: one of 64 is found in 13 jobs. ``stop_on_error`` ends that at the
    first bad month; those after it stay pending. ``transform`` then runs once,
    not once per month.
    """
    spark = source.sparkSession
    # month keys: a few hundred strings at most
    todo = [r["month"] for r in pending_months(spark, start, end, read_log(spark, log_path)).collect()]
    if not todo:
        return {"pending": [], "succeeded": 0, "failed": 0, "extracted": 0}

    def attempt(months: Sequence[str]) -> dict[str, int]:
        return _load(month_frames(source, properties, feed, months, codes), base, months)

    results = _settle(todo, attempt, stop_on_error)
    if transform is not None and any(r[1] == OK for r in results):
        transform()
    log_months(spark, log_path, results)
    return {
        "pending": todo,
        "succeeded": sum(r[1] == OK for r in results),
        "failed": sum(r[1] == FAILED for r in results),
        "extracted": sum(r[2] or 0 for r in results),
    }
