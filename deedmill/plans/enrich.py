"""Linking of property masters, loans and transactions to parcels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from deedmill.functions.parties import name_fingerprint
from deedmill.operators.components import components
from deedmill.operators.similar import clean_name, similar_names
from deedmill.operators.skew import lookup_left, salted_join
from deedmill.session import staged

LINK = ["property_id", "derived_property_id", "tax_assessor_id"]


def enrich_properties(
    mapping: DataFrame, master: DataFrame, columns: Sequence[str], link: Sequence[str] = tuple(LINK)
) -> DataFrame:
    """Mapped properties with columns of the property master."""
    return salted_join(
        mapping.select(*link), master.select("property_id", *columns), "property_id",
        F.struct(*[c for c in link if c != "property_id"]),
    )


def enrich_loans(
    loans: DataFrame, mapping: DataFrame, spread: Sequence[str], link: Sequence[str] = tuple(LINK)
) -> DataFrame:
    """Loans of mapped properties."""
    return salted_join(loans, mapping.select(*link), "property_id", F.struct(*spread))


def enrich_transactions(transactions: DataFrame, parcels: DataFrame) -> DataFrame:
    """Transactions of known parcels, with the derived property id."""
    links = parcels.select("tax_assessor_id", "derived_property_id")
    return salted_join(transactions, links, "tax_assessor_id", F.col("recorder_id"))


# --- fixed values ------------------------------------------------------------
FINGERPRINT = "name_fingerprint"
MISSPELT = "name_edits"
MAX_EDITS = 4
MAX_TYPOS = 2
# --- end of fixed values -----------------------------------------------------


def entity_identifiers(dim_entity: DataFrame, max_edits: int = MAX_EDITS, **limits) -> DataFrame:
    """Fuzzy identifiers: entities whose names are the same words in another form.

    Every entity gets the fingerprint of its name; the entity with the lowest
    key of a fingerprint stands for the rest, and each is compared with that one
    only, so the work is linear however many share a fingerprint. ``is_match``
    says whether the spelling is within ``max_edits`` edits of it.
    """
    marked = dim_entity.select(
        "entity_key",
        F.col("canonical_entity_name").alias("name"),
        name_fingerprint(F.col("canonical_entity_name")).alias("identifier_value"),
    ).where(F.col("identifier_value") != "")
    heads = marked.groupBy("identifier_value").agg(
        F.min("entity_key").alias("resolved_entity_key"),
        F.min_by("name", "entity_key").alias("_head"),
    )
    joined = lookup_left(
        marked, heads, "identifier_value", ["resolved_entity_key", "_head"],
        F.col("identifier_value").isNotNull(), F.col("entity_key"), **limits,
    )
    edits = F.levenshtein(F.upper("name"), F.upper("_head"))
    return joined.select(
        "entity_key",
        F.lit(FINGERPRINT).alias("identifier_type"),
        "identifier_value",
        "resolved_entity_key",
        edits.alias("edits"),
        (edits <= max_edits).alias("is_match"),
    )


def fuzzy_identifiers(dim_entity: DataFrame, max_edits: int = MAX_TYPOS, **limits) -> DataFrame:
    """Fuzzy identifiers by spelling: entities whose names lead to each other by a few edits at a time.

    Names are compared in upper case with punctuation as one space. Two names
    are linked if they hold the same numbers and are at most ``max_edits`` edits
    apart, or a quarter of the shorter one's length where that is less (see
    ``similar_names``). All entities that links reach resolve to the one with
    the lowest key, whose name is their ``identifier_value``; ``n_links`` counts
    the other spellings a name is linked with, ``edits`` is its distance from
    that value, and ``is_match`` says whether they are linked directly. Names
    without letters or digits have no identifier.
    """
    named = dim_entity.select("entity_key", clean_name(F.col("canonical_entity_name")).alias("name")).where("name <> ''")
    named = staged(named, "entity-names")
    heads = staged(named.groupBy("name").agg(F.min("entity_key").alias("head")), "entity-heads")
    links = staged(similar_names(heads.select("name"), max_edits, **limits), "entity-links")
    both = links.select(F.explode(F.array("a", "b")).alias("name"))
    counted = both.groupBy("name").agg(F.count(F.lit(1)).alias("n_links"))
    groups = components(links, **limits).withColumnRenamed("node", "name")
    placed = heads.join(groups, "name").join(counted, "name")
    # of a group the entity with the lowest key, and how it is spelt
    best = placed.groupBy("root").agg(F.min(F.struct("head", "name")).alias("best"))
    resolved = placed.join(best, "root").select(
        F.col("name").alias("_name"), "n_links", F.col("best.head").alias("resolved"), F.col("best.name").alias("value")
    )
    known = links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("b", "a"))
    direct = resolved.join(known, (F.col("_name") == F.col("x")) & (F.col("value") == F.col("y")), "left").select(
        F.col("_name").alias("name"), "n_links", "resolved", "value", F.col("x").isNotNull().alias("direct")
    )
    full = heads.join(direct, "name", "left").select(
        "name",
        F.coalesce("resolved", "head").alias("resolved_entity_key"),
        F.coalesce("value", "name").alias("identifier_value"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.coalesce("direct", F.lit(False)) | F.equal_null("value", "name") | F.col("value").isNull()).alias("is_match"),
    )
    columns = ["resolved_entity_key", "identifier_value", "n_links", "is_match"]
    joined = lookup_left(named, staged(full, "entity-spellings"), "name", columns, F.lit(True), F.col("entity_key"), **limits)
    return joined.select(
        "entity_key",
        F.lit(MISSPELT).alias("identifier_type"),
        "identifier_value",
        "resolved_entity_key",
        "n_links",
        F.levenshtein("name", "identifier_value").alias("edits"),
        "is_match",
    )
