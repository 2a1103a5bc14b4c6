"""Validate: run the quality suite over the model and keep its report."""

from __future__ import annotations

from pyspark.sql import SparkSession

from deedmill.plans import quality
from deedmill.plans.transform import read_model
from deedmill.session import cleans_up
from deedmill.sources.snapshots import read_snapshot, write_snapshot


@cleans_up
def validate_job(
    spark: SparkSession, model_base: str, report_base: str, start=None, end=None
) -> dict:
    """Write ``dq_checks`` and ``dq_stats``; returns the four counters and what failed."""
    table = lambda name: read_model(spark, model_base, name)
    tables = quality.Tables(
        table("dim_property"),
        table("dim_entity"),
        table("fact_transaction"),
        table("bridge_transaction_party"),
        table("bridge_property_owner"),
    )
    checks, stats = quality.validate_all(tables, start, end)
    write_snapshot(checks.repartition(1), f"{report_base}/dq_checks")
    write_snapshot(stats.repartition(1), f"{report_base}/dq_stats")
    written = read_snapshot(spark, f"{report_base}/dq_checks")
    # report rows: a few dozen at most
    summary = quality.report_rollup(written).first().asDict()
    failed = [r.asDict() for r in quality.failed_checks(written).collect()]
    return {**summary, "failed_checks": failed}
