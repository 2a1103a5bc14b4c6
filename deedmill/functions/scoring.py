"""Score, status and texts of data-quality rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values ------------------------------------------------------------
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
WARN_MARGIN = 15
# --- end of fixed values -----------------------------------------------------


def percent(passed: Column, total: Column) -> Column:
    share = passed.cast("double") / F.nullif(total, F.lit(0)).cast("double") * 100
    return F.coalesce(share, F.lit(0.0))


def one_decimal(value: Column) -> Column:
    """Ties go to the even digit of the exact binary value (12.25 is 12.2)."""
    return F.replace(F.format_number(value, 1), F.lit(","), F.lit(""))


def percent_text(value: Column) -> Column:
    return F.concat(one_decimal(value), F.lit("%"))


def status(pct: Column, threshold: Column) -> Column:
    return (
        F.when(pct >= threshold, PASS)
        .when(pct >= threshold - WARN_MARGIN, WARN)
        .otherwise(FAIL)
    )


def grouped(count: Column) -> Column:
    """A count with thousands separators."""
    return F.format_number(count, 0)


def share_text(part: Column, whole: Column) -> Column:
    """``1,234/5,678 (21.7%)``"""
    return F.concat(
        grouped(part), F.lit("/"), grouped(whole),
        F.lit(" ("), percent_text(percent(part, whole)), F.lit(")"),
    )
