"""Cleaning, roll-ups and windows over parcels, loans, series and demographics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.functions.cleaning import (
    clean_date,
    clean_int,
    clean_number,
    derived_property_id,
    dollars_from_millions,
    tract_block_group,
    truncate_decimals,
)
from deedmill.operators.dedupe import first_per_key, latest_per_key
from deedmill.operators.skew import salted_join, settled

# --- fixed values ------------------------------------------------------------
CURRENT_LOAN = "Current"
ACTIVE = "Y"
WINDOW_MONTHS = 24
LOAN_KEYS = ["property_name", "zip", "loan_origination_date", "loan_maturity_date"]
LOAN_RENAMES = {"lender": "lender_name", "originator": "originator_name"}
SUM_COLUMNS = ["assessed_value_total", "building_sq_ft", "units_count"]
LEAST_COLUMNS = ["year_built", "effective_year_built"]
MEAN_COLUMNS = ["assessed_value_improvements"]
GREATEST_COLUMNS = ["last_sale_amount", "prior_sale_amount"]
MODE_COLUMN = "building_sq_ft_code"
# --- end of fixed values -----------------------------------------------------


def merge_snapshots(
    snapshots: DataFrame, key: str, snapshot: str, tiebreak: Sequence[Column | str] = ()
) -> DataFrame:
    """Periodic files merged: per key the row of the latest snapshot."""
    return latest_per_key(snapshots, [key], snapshot, tiebreak)


def clean_loans(
    loans: DataFrame,
    tiebreak: Sequence[Column | str],
    keys: Sequence[str] = tuple(LOAN_KEYS),
    amount: str = "loan_amount(MM)",
    status: str = "loan_status",
    current: str = CURRENT_LOAN,
) -> DataFrame:
    """Current loans in dollars, one per key, names of the parties renamed."""
    ties = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in tiebreak]
    one = first_per_key(loans.where(F.col(status) == current), list(keys), ties)
    dollars = one.withColumn("loan_amount", dollars_from_millions(F.col(f"`{amount}`"))).drop(amount)
    return dollars.withColumnsRenamed(LOAN_RENAMES)


def active_mapping(mapping: DataFrame, flag: str = "active_flag", active: str = ACTIVE) -> DataFrame:
    """Active links between property and parcel, with the derived property id."""
    return mapping.where(F.col(flag) == active).withColumn(
        "derived_property_id", derived_property_id(F.col("identifier"), F.col("zip"))
    )


def clean_parcels(
    parcels: DataFrame,
    counts: Sequence[str],
    codes: Sequence[str],
    integers: Sequence[str] = (),
    dates: Sequence[str] = (),
    ts: str | None = None,
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """Typed parcel rows, one per tax id, with derived property id and tract group.

    Which row of a tax id stays is decided before anything is cleaned.
    """
    keys = ["tax_assessor_id"]
    if ts is None:
        one = first_per_key(parcels, keys, [F.asc_nulls_last(c) if isinstance(c, str) else c for c in tiebreak])
    else:
        one = latest_per_key(parcels, keys, ts, tiebreak)
    cleaned = {c: clean_number(F.col(c)) for c in counts}
    cleaned |= {c: truncate_decimals(F.col(c)) for c in codes}
    cleaned |= {c: clean_int(F.col(c)) for c in integers}
    cleaned |= {c: clean_date(F.col(c)) for c in dates}
    return one.withColumns(
        {
            "derived_property_id": derived_property_id(F.col("identifier"), F.col("zip")),
            "fips_tract_block_group": tract_block_group(
                F.col("fips_code"), F.col("census_tract"), F.col("census_block_group")
            ),
        }
    ).withColumns(cleaned)


def rollup_parcels(
    parcels: DataFrame,
    key: str = "derived_property_id",
    first_by: Sequence[str] = ("tax_assessor_id", "year_built"),
    first: Sequence[str] = ("tax_assessor_id",),
    sums: Mapping[str, str] | None = None,
    least: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    greatest: Mapping[str, str] | None = None,
    mode: tuple[str, str] | None = (MODE_COLUMN, MODE_COLUMN),
) -> DataFrame:
    """Parcels of one property as one row; mappings read {output: input}.

    Two levels: parcels are first reduced per (property, mode value), then those
    partial rows per property. The mode so comes from counts, never from the set
    of all values of a property in one buffer; ties go to the lowest value.
    Money sums want decimal inputs.
    """
    sums = {c: c for c in SUM_COLUMNS} if sums is None else sums
    least = {c: c for c in LEAST_COLUMNS} if least is None else least
    means = {c: c for c in MEAN_COLUMNS} if means is None else means
    greatest = {c: c for c in GREATEST_COLUMNS} if greatest is None else greatest

    place = F.struct(*[x for c in first_by for x in (F.col(c).isNull(), F.col(c))])
    partial = [F.count(F.lit(1)).alias("_n"), F.min(place).alias("_place")]
    partial.append(F.min_by(F.struct(*first), place).alias("_first"))
    partial += [F.sum(c).alias(f"_sum_{out}") for out, c in sums.items()]
    partial += [F.min(c).alias(f"_least_{out}") for out, c in least.items()]
    partial += [F.max(c).alias(f"_greatest_{out}") for out, c in greatest.items()]
    for out, c in means.items():
        partial += [F.sum(c).alias(f"_total_{out}"), F.count(c).alias(f"_count_{out}")]
    value = F.col(mode[0]) if mode else F.lit(None)
    per_value = parcels.groupBy(key, value.alias("_value")).agg(*partial)

    final = [F.min_by("_first", "_place").alias("_first"), F.sum("_n").alias("parcels")]
    final += [F.sum(f"_sum_{out}").alias(out) for out in sums]
    final += [F.min(f"_least_{out}").alias(out) for out in least]
    final += [F.max(f"_greatest_{out}").alias(out) for out in greatest]
    for out in means:
        mean = F.sum(f"_total_{out}").cast("double") / F.nullif(F.sum(f"_count_{out}"), F.lit(0))
        final.append(mean.alias(out))
    if mode:
        rank = F.when(F.col("_value").isNotNull(), F.struct(-F.col("_n"), F.col("_value")))
        final.append(F.min_by("_value", rank).alias(mode[1]))
    rolled = per_value.groupBy(key).agg(*final)
    return rolled.select(key, *[F.col("_first")[c].alias(c) for c in first], *rolled.columns[2:])


def agg_series(
    series: DataFrame,
    mapping: DataFrame,
    name: str,
    window: Column | None = None,
    months: int = WINDOW_MONTHS,
    enrich: DataFrame | None = None,
) -> DataFrame:
    """One series per mapped property, over the window that ends at its newest date.

    The newest date is that of the whole series, mapped or not. ``window`` may
    give another start of the window in terms of the column ``newest``.
    """
    rows = series.where(F.col("series") == name)
    newest = rows.agg(F.max("record_date")).scalar()
    start = F.add_months(F.col("newest"), -months) if window is None else window
    recent = rows.withColumn("newest", newest).where(F.col("record_date") >= start).drop("newest")
    spread = F.struct("record_date", "record_values")
    joined = salted_join(recent, mapping, "property_id", spread)
    if enrich is None:
        return joined
    return salted_join(settled(joined, enrich, "series-rows"), enrich, "property_id", spread)


def latest_vintage(demographics: DataFrame, vintage: str | None = None) -> DataFrame:
    """Rows of one vintage, the newest unless given."""
    wanted = F.lit(vintage) if vintage else demographics.agg(F.max("vintage")).scalar()
    return demographics.where(F.col("vintage") == wanted)


def demographics_by_tract(
    properties: DataFrame, demographics: DataFrame, tract: str, vintage: str | None = None
) -> DataFrame:
    """Properties with the demographics of their census tract."""
    area = latest_vintage(demographics, vintage).withColumnRenamed("geography_code", tract)
    return salted_join(properties, area, tract, F.col("tax_assessor_id"))


def agg_demographic(
    properties: DataFrame,
    demographics: DataFrame,
    tract: str,
    measures: Sequence[str],
    key: str = "derived_property_id",
    vintage: str | None = None,
) -> DataFrame:
    """Demographic measures per property and parcel."""
    joined = demographics_by_tract(properties, demographics, tract, vintage)
    return joined.select(key, "tax_assessor_id", "zip", "vintage", *measures)
