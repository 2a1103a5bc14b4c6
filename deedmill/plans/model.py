"""Dimensions and fact, as functions from raw rows to model rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from deedmill import schemas
from deedmill.functions.deals import classify_transaction, is_sale
from deedmill.functions.parties import canonical_id, classify_entity, normalize_name
from deedmill.functions.truth import flag, truthy_text
from deedmill.operators.asof import lookup_as_of
from deedmill.operators.dedupe import first_per_key, latest_per_key
from deedmill.operators.history import scd2_history
from deedmill.operators.joins import unique_lookup
from deedmill.operators.keys import attach_keys
from deedmill.operators.skew import lookup_left, settled
from deedmill.schemas import Feed
from deedmill.sources.raw import open_envelope, resolved_ids, with_resolved_id

# --- fixed values ------------------------------------------------------------
FIRST_DAY = "2025-01-01"
DEFAULT_CONFIDENCE = 50
DEFAULT_OCCURRENCES = 1
RESOLUTION_METHOD = "name_normalization"
ROLES = ["grantor", "grantee"]
# --- end of fixed values -----------------------------------------------------


def scd_columns(feed: Feed) -> list:
    """One open interval: history proper comes from ``scd2_history``."""
    return [
        F.lit(FIRST_DAY).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(feed.name).alias("source_system"),
    ]


# ---- property dimension ------------------------------------------------------


def latest_properties(raw: DataFrame) -> DataFrame:
    """Newest document per property; ids fall back to the one in the document.

    The document stays closed through the shuffle and is parsed for the
    surviving rows only.
    """
    return _open_properties(
        latest_per_key(with_resolved_id(raw, "tax_assessor_id"), ["tax_assessor_id"], "extracted_at", ["data"])
    )


def _open_properties(rows: DataFrame) -> DataFrame:
    opened = open_envelope(rows, schemas.raw_property(), ("extracted_at", "tax_assessor_id"))
    return opened.withColumn("tax_assessor_id", F.col("_tax_assessor_id")).drop("_tax_assessor_id")


def project_dim_property(properties: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    """All dimension columns but the surrogate key, and those in ``keep`` as they are."""
    whole = lambda name: F.col(name).try_cast("double").try_cast("int")
    money = lambda name: F.col(name).try_cast(schemas.MONEY)
    return properties.select(
        "tax_assessor_id",
        F.col("assessor_parcel_number_raw").alias("assessor_parcel_number"),
        F.col("address").alias("property_address"),
        F.col("city").alias("property_city"),
        F.col("state").alias("property_state"),
        F.col("zip").alias("property_zip"),
        F.col("situs_county").alias("property_county"),
        F.col("property_use_standardized_code").alias("property_use_code"),
        F.lit(None).cast("string").alias("land_use_code"),
        whole("year_built").alias("year_built"),
        whole("building_sq_ft").alias("building_sqft"),
        whole("lot_size_sq_ft").alias("land_sqft"),
        whole("units_count").alias("units_count"),
        money("assessed_value_total").alias("assessed_value"),
        money("market_value_total").alias("market_value"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        *scd_columns(feed),
        *keep,
    )


def build_dim_property(
    raw_properties: DataFrame, feed: Feed, known: DataFrame | None = None
) -> DataFrame:
    rows = project_dim_property(latest_properties(raw_properties), feed)
    return attach_keys(rows, ["tax_assessor_id"], "property_key", known)


def property_versions(raw: DataFrame, feed: Feed) -> DataFrame:
    """Every state of every property: the rows of the dimension with the days between which they were valid.

    A version is what the documents of one day say last; without a time it counts from the first day.
    """
    newest = latest_per_key(
        with_resolved_id(raw, "tax_assessor_id").withColumn(
            "_day", F.coalesce(F.to_date("extracted_at"), F.lit(FIRST_DAY).cast("date"))
        ),
        ["tax_assessor_id", "_day"], "extracted_at", ["data"],
    )
    opened = open_envelope(newest, schemas.raw_property(), ("tax_assessor_id", "_day"))
    opened = opened.withColumn("tax_assessor_id", F.col("_tax_assessor_id"))
    rows = project_dim_property(opened, feed, keep=["__day"])
    columns = [c for c in rows.columns if c != "__day"]
    states = [c for c in columns if c not in ("tax_assessor_id", "valid_from", "valid_to", "is_current")]
    # one row per property and day by now
    return scd2_history(rows, "tax_assessor_id", "__day", states, [F.asc("source_system")]).select(*columns)


def build_dim_property_history(raw_properties: DataFrame, feed: Feed, known: DataFrame | None = None) -> DataFrame:
    """The dimension with all versions; a version keeps its surrogate key."""
    return attach_keys(property_versions(raw_properties, feed), ["tax_assessor_id", "valid_from"], "property_key", known)


# ---- entity dimension --------------------------------------------------------


def open_parties(raw: DataFrame, role: str, feed: Feed) -> DataFrame:
    return open_envelope(raw, schemas.raw_party(feed, role), once=True)


def union_parties(grantors: DataFrame, grantees: DataFrame, feed: Feed) -> DataFrame:
    """Both roles in one shape, rows without a name left out."""
    shaped = []
    for rank, (role, df) in enumerate(zip(ROLES, (grantors, grantees))):
        seen = F.col("_extracted_at") if "_extracted_at" in df.columns else F.lit(None).cast("timestamp")
        shaped.append(
            df.where(truthy_text(F.col(f"{role}_name"))).select(
                F.col("recorder_id"),
                F.col(f"{role}_name").alias("name"),
                F.col(f"{role}_entity_code").alias("entity_code"),
                F.col(f"{role}_first_name").alias("first_name"),
                F.col(f"{role}_last_name").alias("last_name"),
                F.lit(role.upper()).alias("role"),
                F.col(feed.party_key(role)).alias("source_pk"),
                F.lit(rank).alias("role_rank"),
                seen.alias("seen_at"),
            )
        )
    return shaped[0].unionByName(shaped[1])


def _mention_order() -> list:
    """Grantors first, then oldest, then by ids."""
    return [
        F.asc("role_rank"),
        F.asc_nulls_first("seen_at"),
        F.asc_nulls_last("recorder_id"),
        F.asc_nulls_last("source_pk"),
        F.asc("name"),
        F.asc_nulls_last("entity_code"),
        F.asc_nulls_last("first_name"),
        F.asc_nulls_last("last_name"),
    ]


#: What is kept of a name's first mention: its place in the order, and what the entity is made of.
MENTION = ["normalized", "role_rank", "seen_at", "recorder_id", "source_pk", "name", "entity_code", "first_name", "last_name"]


def first_parties(parties: DataFrame, drop_blank: bool = False) -> DataFrame:
    """First party per normalized name: grantors first, then oldest, then by ids."""
    named = parties.withColumn("normalized", normalize_name(F.col("name")))
    if drop_blank:
        named = named.where(F.col("normalized") != "")
    return first_per_key(named, ["normalized"], _mention_order())


def earlier_mentions(known: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """First mentions (``MENTION``) of both: of first mentions the first is the first of all, whatever the loads."""
    return fresh if known is None else first_per_key(known.unionByName(fresh), ["normalized"], _mention_order())


def project_dim_entity(firsts: DataFrame, feed: Feed) -> DataFrame:
    kind = classify_entity(F.col("entity_code"), F.col("first_name"), F.col("last_name"))
    return firsts.select(
        canonical_id(F.col("normalized"), feed.name).alias("canonical_entity_id"),
        F.col("name").alias("canonical_entity_name"),
        kind.alias("entity_type"),
        F.lit(None).cast("string").alias("state"),
        F.lit(DEFAULT_CONFIDENCE).alias("confidence_score"),
        F.lit(DEFAULT_OCCURRENCES).alias("occurrences_count"),
        F.lit(True).alias("is_resolved"),
        F.lit(RESOLUTION_METHOD).alias("resolution_method"),
        *scd_columns(feed),
    )


def count_occurrences(parties: DataFrame, feed: Feed) -> DataFrame:
    """How often each canonical id occurs, for callers who want true counts."""
    ident = canonical_id(normalize_name(F.col("name")), feed.name).alias("canonical_entity_id")
    return parties.groupBy(ident).agg(F.count(F.lit(1)).alias("occurrences_count"))


def entities_from_parties(
    parties: DataFrame,
    feed: Feed,
    known: DataFrame | None = None,
    drop_blank: bool = False,
    true_counts: bool = False,
) -> DataFrame:
    rows = project_dim_entity(first_parties(parties, drop_blank), feed)
    if true_counts:
        columns = rows.columns
        counts = count_occurrences(parties, feed)
        rows = rows.drop("occurrences_count").join(counts, "canonical_entity_id").select(*columns)
    return attach_keys(rows, ["canonical_entity_id"], "entity_key", known)


def build_dim_entity(
    raw_grantors: DataFrame,
    raw_grantees: DataFrame,
    feed: Feed,
    known: DataFrame | None = None,
    drop_blank: bool = False,
    true_counts: bool = False,
) -> DataFrame:
    grantors, grantees = (
        open_parties(raw, role, feed) for raw, role in zip((raw_grantors, raw_grantees), ROLES)
    )
    parties = union_parties(grantors, grantees, feed)
    return entities_from_parties(parties, feed, known, drop_blank, true_counts)


# ---- transaction fact --------------------------------------------------------


def latest_transactions(raw: DataFrame, feed: Feed) -> DataFrame:
    """Newest document per recorded transaction; overlapping loads repeat them."""
    newest = latest_per_key(
        with_resolved_id(raw, "recorder_id"), ["recorder_id"], "extracted_at", ["data"]
    )
    opened = open_envelope(newest, schemas.raw_transaction(feed), ("recorder_id",))
    return opened.withColumn("recorder_id", F.col("_recorder_id")).drop("_recorder_id")


def type_transactions(transactions: DataFrame) -> DataFrame:
    """Text fields of a parsed document to dates, money and counts."""
    typed = {c: F.col(c).try_cast("date") for c in ("document_recorded_date", "document_instrument_date")}
    typed |= {c: F.col(c).try_cast(schemas.MONEY) for c in ("document_amount", "transfer_tax_amount")}
    typed |= {c: F.col(c).try_cast("int") for c in ("grantor_count", "grantee_count")}
    return transactions.withColumns(typed)


def property_lookup(dim_property: DataFrame) -> DataFrame:
    return unique_lookup(
        dim_property, "tax_assessor_id", "property_key", truthy_text(F.col("tax_assessor_id")), "is_current"
    )


def lookup_property_key(transactions: DataFrame, lookup: DataFrame, **limits) -> DataFrame:
    """Adds ``property_key``; NULL where the property is unknown or not given."""
    return lookup_left(
        transactions,
        lookup,
        "tax_assessor_id",
        ["property_key"],
        truthy_text(F.col("tax_assessor_id")),
        F.col("recorder_id"),
        **limits,
    )


def lookup_property_as_of(transactions: DataFrame, dim_property: DataFrame, **limits) -> DataFrame:
    """Adds the ``property_key`` of the version that was valid on the day a transaction was recorded.

    Before its first version a property is what that one says: records begin
    later than deeds.
    """
    first = F.row_number().over(Window.partitionBy("tax_assessor_id").orderBy("valid_from")) == 1
    versions = dim_property.where(truthy_text(F.col("tax_assessor_id"))).select(
        "tax_assessor_id", "property_key", "valid_to", F.when(~first, F.col("valid_from")).alias("since")
    )
    return lookup_as_of(
        transactions, versions, "tax_assessor_id", "document_recorded_date", ["property_key"],
        truthy_text(F.col("tax_assessor_id")), F.col("recorder_id"), starts="since", **limits,
    )


def project_fact(
    transactions: DataFrame, feed: Feed, flags: str = "python", keys: Sequence[str] = ()
) -> DataFrame:
    """All fact columns; ``keys`` go before them as they are."""
    arms, amount = F.col("arms_length_code"), F.col("document_amount")
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("int").alias(name)
    return transactions.select(
        *keys,
        "recorder_id",
        "property_key",
        F.col("document_recorded_date").alias("transaction_date"),
        F.col("document_instrument_date").alias("instrument_date"),
        F.col("document_number_formatted").alias("document_number"),
        "document_type_code",
        "document_amount",
        "transfer_tax_amount",
        classify_transaction(arms, amount).alias("transaction_category"),
        is_sale(arms, amount).alias("is_sale"),
        flag(arms, flags).alias("is_arms_length"),
        flag(F.col("inter_family_flag"), flags).alias("is_inter_family"),
        flag(F.col("is_foreclosure_auction_sale"), flags).alias("is_foreclosure"),
        flag(F.col("is_quit_claim"), flags).alias("is_quit_claim"),
        flag(F.col("new_construction_flag"), flags).alias("is_new_construction"),
        flag(F.col("resale_flag"), flags).alias("is_resale"),
        count("grantor_count"),
        count("grantee_count"),
        "property_address",
        "property_city",
        "property_state",
        "property_zip",
        F.lit(feed.name).alias("source_system"),
        F.col(feed.ingest_column).try_cast("timestamp").alias(feed.ingest_column),
    )


def build_fact_transaction(
    raw_transactions: DataFrame,
    dim_property: DataFrame,
    feed: Feed,
    known: DataFrame | None = None,
    flags: str = "python",
    as_of: bool = False,
) -> DataFrame:
    """Newest document per transaction, with its key, then the property lookup.

    ``as_of`` takes the property's version of the day of the transaction in place of its current row.

    Deduplication and keys share one partitioning by transaction id; the lookup
    comes last. Rows are written once before it where the dimension is large.
    """
    typed = type_transactions(latest_transactions(raw_transactions, feed))
    ids = resolved_ids(raw_transactions, "recorder_id")
    keyed = attach_keys(typed, ["recorder_id"], "transaction_key", known, ids)
    if as_of:
        return project_fact(lookup_property_as_of(keyed, dim_property), feed, flags, ["transaction_key"])
    lookup = property_lookup(dim_property)
    looked = lookup_property_key(settled(keyed, lookup, "fact-rows"), lookup)
    return project_fact(looked, feed, flags, ["transaction_key"])


# ---- bridges -----------------------------------------------------------------


def build_bridge_transaction_party(
    parties: DataFrame, fact: DataFrame, dim_entity: DataFrame, feed: Feed, keep: Sequence[str] = (), **limits
) -> DataFrame:
    """One row per party of a transaction, roles in lower case.

    A name that very many deeds share (a large bank) is a hot key of the entity
    lookup and is joined apart. ``keep`` names columns of parties or fact to add.
    """
    one_party = F.struct("recorder_id", "source_pk", "role")
    # a deed has few parties, so no key is hot here
    wanted = [c for c in keep if c not in parties.columns]
    keyed = parties.join(fact.select("recorder_id", "transaction_key", *wanted), "recorder_id")
    keyed = keyed.withColumn(
        "canonical_entity_id", canonical_id(normalize_name(F.col("name")), feed.name)
    )
    entities = dim_entity.where("is_current").select("canonical_entity_id", "entity_key")
    looked = lookup_left(
        settled(keyed, entities, "party-rows"),
        entities,
        "canonical_entity_id",
        ["entity_key"],
        F.col("canonical_entity_id").isNotNull(),
        one_party,
        **limits,
    )
    return looked.select(
        "transaction_key",
        "entity_key",
        F.lower("role").alias("party_role"),
        F.col("name").alias("party_name_raw"),
        *keep,
    )


def build_bridge_property_owner(fact: DataFrame, bridge_party: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Owners of a property: the grantees of its latest sale; ``keep`` may name the sale's ``transaction_key``."""
    latest = latest_sales(fact)
    owners = bridge_party.where((F.col("party_role") == "grantee") & F.col("entity_key").isNotNull())
    # one sale per property and few parties per sale: no key is hot
    owned = owners.join(latest.select("transaction_key", "property_key"), "transaction_key")
    return owned.select("property_key", "entity_key", *keep).distinct()


def latest_sales(fact: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The latest sale of each property: ``property_key``, ``transaction_key``, ``transaction_date`` and ``keep``."""
    sales = fact.where(F.col("is_sale") & F.col("property_key").isNotNull()).select(
        "property_key", "transaction_key", "transaction_date", *keep
    )
    return latest_per_key(sales, ["property_key"], "transaction_date", [F.desc("transaction_key")])
