"""Transaction categories."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from deedmill.functions.truth import truthy_text

# --- fixed values ------------------------------------------------------------
SALE, MORTGAGE, OTHER = "SALE", "MORTGAGE", "OTHER"
# multifamily use codes
USE_CODES = ["1104", "1105", "1106", "1107", "1108", "1110", "1112"]
# --- end of fixed values -----------------------------------------------------


def is_sale(arms_length: Column, amount: Column) -> Column:
    return truthy_text(arms_length) & F.coalesce(amount > 0, F.lit(False))


def classify_transaction(arms_length: Column, amount: Column) -> Column:
    return (
        F.when(is_sale(arms_length, amount), SALE)
        .when(amount == 0, MORTGAGE)
        .otherwise(OTHER)
    )
