"""Extract: a bounded range of nested transactions into the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from deedmill import schemas
from deedmill.functions.calendar import default_window
from deedmill.functions.deals import USE_CODES
from deedmill.functions.truth import truthy_text
from deedmill.operators.dedupe import distinct_ids
from deedmill.operators.joins import keyed_rows
from deedmill.operators.nested import explode_children, flatten_counts
from deedmill.plans.audit import load_summary
from deedmill.schemas import Feed
from deedmill.session import staged
from deedmill.sources.raw import append_raw, wrap_raw
from deedmill.sources.scan import scan_date_range

# raw table -> id column of its envelope
RAW_TABLES = {
    "transactions": "recorder_id",
    "grantors": "recorder_id",
    "grantees": "recorder_id",
    "mortgages": "recorder_id",
    "properties": "tax_assessor_id",
    "owners": "tax_assessor_id",
    "owners_unmask": "tax_assessor_id",
}


def flatten_transactions(nested: DataFrame) -> DataFrame:
    """Transactions without the party arrays, with the counts of parties.

    Mortgages are a table of their own and leave the document as well.
    """
    counts = {f"{role}_count": array for role, array in schemas.PARTY_ARRAY.items()}
    flat = flatten_counts(nested, schemas.NESTED_PARTY_PREFIX, counts)
    return flat.drop(schemas.MORTGAGE_ARRAY)


def explode_parties(nested: DataFrame, role: str, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    return explode_children(
        nested, [*keep, "recorder_id"], schemas.PARTY_ARRAY[role], feed.party_fields(role)
    )


def explode_mortgages(nested: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    return explode_children(
        nested, [*keep, "recorder_id"], schemas.MORTGAGE_ARRAY, feed.mortgage_fields(), drop_empty=True
    )


def explode_owners(nested: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    return explode_children(
        nested, [*keep, "tax_assessor_id"], schemas.OWNER_ARRAY, feed.owner_fields(), drop_empty=True
    )


def explode_unmask(nested: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    return explode_children(
        nested, [*keep, "tax_assessor_id"], schemas.UNMASK_ARRAY, feed.unmask_fields(), drop_empty=True
    )


def properties_of(
    transactions: DataFrame,
    properties: DataFrame,
    codes: Sequence[str] | None = USE_CODES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Properties that the transactions name, of the given use codes.

    With ``keep``, once per distinct value of those transaction columns.
    """
    named = truthy_text(F.col("tax_assessor_id"))
    if not keep:
        ids = distinct_ids(transactions, "tax_assessor_id", named)
        return keyed_rows(properties, ids, "tax_assessor_id", "property_use_standardized_code", codes)
    if codes is not None:
        properties = properties.where(F.col("property_use_standardized_code").isin(list(codes)))
    ids = transactions.where(named).select(*keep, "tax_assessor_id").distinct()
    return properties.join(ids, "tax_assessor_id")


def raw_loads(
    nested: DataFrame,
    properties: DataFrame,
    feed: Feed,
    extracted_at: Column,
    codes: Sequence[str] | None = USE_CODES,
    keep: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The raw loads as lazy frames; ``keep`` columns stay beside the documents.

    Mortgages and owners come along where the source nests them. Each load
    reads the source itself: the columns they need hardly overlap, so with
    nested column pruning narrow scans read what one wide scan would, and
    nothing has to be held.
    """
    known = properties_of(nested, properties, codes, keep)
    if schemas.OWNER_ARRAY in properties.columns or schemas.UNMASK_ARRAY in properties.columns:
        # several loads of the same properties: which these are is worked out once
        ids = staged(known.select(*keep, "tax_assessor_id").distinct(), "property-ids")
        known = properties.join(ids, "tax_assessor_id") if keep else keyed_rows(properties, ids, "tax_assessor_id", "property_use_standardized_code", codes)
        if keep and codes is not None:
            known = known.where(F.col("property_use_standardized_code").isin(list(codes)))
    loads = {
        "transactions": flatten_transactions(nested),
        "grantors": explode_parties(nested, "grantor", feed, keep),
        "grantees": explode_parties(nested, "grantee", feed, keep),
        "properties": known.drop(schemas.OWNER_ARRAY, schemas.UNMASK_ARRAY),
    }
    if schemas.MORTGAGE_ARRAY in nested.columns:
        loads["mortgages"] = explode_mortgages(nested, feed, keep)
    if schemas.OWNER_ARRAY in properties.columns:
        loads["owners"] = explode_owners(known, feed, keep)
    if schemas.UNMASK_ARRAY in properties.columns:
        loads["owners_unmask"] = explode_unmask(known, feed, keep)
    return {t: wrap_raw(df, RAW_TABLES[t], extracted_at, keep) for t, df in loads.items()}


def extract_frames(
    source: DataFrame,
    properties: DataFrame,
    feed: Feed,
    start: Column,
    end: Column,
    extracted_at: Column,
    codes: Sequence[str] | None = USE_CODES,
) -> dict[str, DataFrame]:
    """The raw loads of the days from ``start`` to ``end``, both in."""
    nested = scan_date_range(source, "document_recorded_date", start, end)
    return raw_loads(nested, properties, feed, extracted_at, codes)


def extract_job(
    source: DataFrame,
    properties: DataFrame,
    base: str,
    feed: Feed,
    start: str | None = None,
    end: str | None = None,
    as_of: str | None = None,
    codes: Sequence[str] | None = USE_CODES,
    run: str | None = None,
) -> dict:
    """Land one window (yesterday to today unless given); returns counts per table.

    A run that is given a name lands under it and replaces what an earlier try
    of that name has left, table by table. Without a name loads are appended
    under the window's last day.
    """
    spark = source.sparkSession
    # two literal days; one row, not data
    first, last = spark.range(1).select(*default_window(start, end, as_of)).first()
    stamp = spark.range(1).select(F.current_timestamp()).first()[0] if as_of is None else as_of
    frames = extract_frames(
        source, properties, feed, F.lit(first), F.lit(last), F.lit(stamp).cast("timestamp"), codes
    )
    batch, again = run or str(last), run is not None
    counts = {t: append_raw(df, f"{base}/{t}", batch, t, replace=again) for t, df in frames.items()}
    return {"date_range": {"start": str(first), "end": str(last)}, **load_summary(counts)}
