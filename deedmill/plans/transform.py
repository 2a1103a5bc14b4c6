"""Transform: raw tables into the dimensional model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from deedmill.operators.dedupe import first_per_key
from deedmill.operators.keys import attach_keys
from deedmill.plans import model
from deedmill.plans.audit import load_summary
from deedmill.plans.extract import RAW_TABLES
from deedmill.schemas import Feed
from deedmill.session import cleans_up, staged
from deedmill.sources.buckets import merge_buckets, read_buckets
from deedmill.sources.raw import read_raw, resolved_ids
from deedmill.sources.snapshots import (
    path_exists,
    read_partitions,
    read_snapshot,
    replace_partitions,
    upsert_partitions,
    upsert_snapshot,
    write_snapshot,
)

# model table -> natural key; the conflict key of its upsert
NATURAL_KEYS = {
    "dim_property": ["tax_assessor_id"],
    "dim_entity": ["canonical_entity_id"],
    "fact_transaction": ["recorder_id"],
}
MODEL_SOURCES = ["transactions", "grantors", "grantees", "properties"]
MONTH = "transaction_month"
UNDATED = "undated"
#: First mention of each name, from which the entity dimension is made.
MENTIONS = "entity_mentions"
#: Parties whose transaction has not come yet.
WAITING = "waiting_parties"
#: What tells a party apart, and what the bridge keeps of it beside its own columns.
ONE_PARTY = ["recorder_id", "role", "source_pk", "name"]
BRIDGE = ["transaction_key", "entity_key", "party_role", "party_name_raw"]
KEPT = ["recorder_id", "role", "source_pk", "seen_at", MONTH]


def read_raw_tables(
    spark: SparkSession, base: str, batches: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The raw tables, or only some loads of them (other folders are not read)."""
    tables = {t: read_raw(spark, f"{base}/{t}", RAW_TABLES[t]) for t in MODEL_SOURCES}
    if batches is not None:
        tables = {t: df.where(F.col("batch").isin(list(batches))) for t, df in tables.items()}
    return tables


def read_model(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """A model table as last written; None where there is none yet."""
    if table == "bridge_property_owner":
        owners = read_buckets(spark, f"{base}/{table}")
        return None if owners is None else owners.select("property_key", "entity_key")
    if table in ("fact_transaction", "bridge_transaction_party"):
        rows = read_partitions(spark, f"{base}/{table}", MONTH)
        return None if rows is None else rows.drop(*(KEPT if table == "bridge_transaction_party" else [MONTH]))
    return read_snapshot(spark, f"{base}/{table}")


def _parties(raw: dict[str, DataFrame], feed: Feed) -> DataFrame:
    return model.union_parties(*[model.open_parties(raw[f"{r}s"], r, feed) for r in model.ROLES], feed)


def _load_entities(
    spark: SparkSession, raw_base: str, model_base: str, feed: Feed, batches: Sequence[str] | None, known: DataFrame | None, stamp
) -> int:
    """Upsert the entities that the loads name, by the first mention of each name so far.

    The first mentions are kept in a table of their own: of those of some loads
    and those of all before, the earlier one is the first of all, in whatever
    order loads come. So only the new loads' parties are read, and only the
    buckets of their names. Without that table all parties are read once.
    """
    place = f"{model_base}/{MENTIONS}"
    only_new = batches is not None and read_buckets(spark, place) is not None
    raw = read_raw_tables(spark, raw_base, batches if only_new else None)
    fresh = staged(model.first_parties(_parties(raw, feed)).select(*model.MENTION), "mentions")
    merge_buckets(fresh, place, ["normalized"], model.earlier_mentions, whole=not only_new)
    firsts = read_buckets(spark, place)
    if only_new:
        firsts = firsts.join(fresh.select("normalized"), "normalized", "left_semi")
    rows = attach_keys(model.project_dim_entity(firsts, feed), ["canonical_entity_id"], "entity_key", known)
    return upsert_snapshot(rows, f"{model_base}/dim_entity", NATURAL_KEYS["dim_entity"], stamp=stamp)


@cleans_up
def transform_job(
    spark: SparkSession,
    raw_base: str,
    model_base: str,
    feed: Feed,
    batches: Sequence[str] | None = None,
    history: bool = False,
) -> dict:
    """Build and upsert both dimensions, then the fact, which looks up the first.

    Surrogate keys of rows the model knows are kept. The fact is partitioned by
    month and only months with changes are rewritten. ``batches`` limits the job
    to newly landed loads: properties and transactions replace what earlier loads
    said, so the result is that of a full run as long as loads are taken in their
    order; entities do not depend on the order.

    With ``history`` the property dimension holds every version, made from all
    loads and written whole, and a transaction looks up the one of its day; facts
    of earlier loads keep the version they got.
    """
    raw = read_raw_tables(spark, raw_base, batches)
    stamp = F.current_timestamp()
    known = {t: read_model(spark, model_base, t) for t in NATURAL_KEYS}

    place = f"{model_base}/dim_property"
    if history:
        versions = model.build_dim_property_history(read_raw_tables(spark, raw_base)["properties"], feed, known["dim_property"])
        properties = write_snapshot(versions.withColumns({"created_at": stamp, "updated_at": stamp}), place)
    else:
        properties = upsert_snapshot(
            model.build_dim_property(raw["properties"], feed, known["dim_property"]), place, NATURAL_KEYS["dim_property"], stamp=stamp
        )
    counts = {
        "dim_property": properties,
        "dim_entity": _load_entities(spark, raw_base, model_base, feed, batches, known["dim_entity"], stamp),
    }
    dim_property = read_model(spark, model_base, "dim_property")
    fact = model.build_fact_transaction(
        raw["transactions"], dim_property, feed, known["fact_transaction"], as_of=history
    ).withColumn(MONTH, F.coalesce(F.date_format("transaction_date", "yyyy-MM"), F.lit(UNDATED)))
    counts["fact_transaction"] = upsert_partitions(
        fact, f"{model_base}/fact_transaction", NATURAL_KEYS["fact_transaction"], MONTH, stamp=stamp
    )
    return load_summary(counts)


@cleans_up
def bridges_job(
    spark: SparkSession, raw_base: str, model_base: str, feed: Feed, batches: Sequence[str] | None = None
) -> dict:
    """Both bridges, from the model's current state.

    Without ``batches`` they are made anew from all loads. With ``batches``, the
    loads that the transform has just taken in, only what these change is: the
    transactions that they hold, or hold parties of, and the properties whose
    latest sale one of them was or is now. The party bridge lies in months, of
    which only those with such transactions are rewritten; parties that come
    before their transaction wait in a table of their own.
    """
    place = f"{model_base}/bridge_transaction_party"
    fact = read_partitions(spark, f"{model_base}/fact_transaction", MONTH)
    entities = read_model(spark, model_base, "dim_entity")
    only_new = batches is not None and path_exists(spark, place)
    raw = read_raw_tables(spark, raw_base, batches if only_new else None)
    parties = _parties(raw, feed).select("recorder_id", "role", "source_pk", "name", "seen_at")
    changed = None
    if only_new:
        # read for the ids and for themselves: documents are parsed once
        parties = staged(parties, "new-parties")
        ids = resolved_ids(raw["transactions"], "recorder_id").union(parties.select("recorder_id"))
        changed = staged(ids.where("recorder_id IS NOT NULL").distinct(), "changed-ids")
        fact = _of_changed_months(fact, changed)
        bridged = _of_changed_months(read_partitions(spark, place, MONTH), changed)
        parties = parties.unionByName(bridged.select(*ONE_PARTY[:3], F.col("party_name_raw").alias("name"), "seen_at"))
        waiting = read_buckets(spark, f"{model_base}/{WAITING}")
        if waiting is not None:
            parties = parties.unionByName(waiting.join(changed, "recorder_id", "left_semi"))
    # overlapping loads repeat parties
    once = staged(first_per_key(parties, ONE_PARTY, [F.asc("seen_at")]), "parties")
    bridge = staged(model.build_bridge_transaction_party(once, fact, entities, feed, keep=KEPT), "bridge")
    replace_partitions(bridge, place, ["recorder_id"], MONTH, whole=not only_new)
    _keep_waiting(once, fact, changed, f"{model_base}/{WAITING}")
    owners = _load_owners(spark, model_base, fact, bridge, changed)
    return load_summary({"bridge_transaction_party": bridge.count(), "bridge_property_owner": owners})


def _of_changed_months(rows: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of the changed transactions: ids of all months are read, all columns only of the months that hold one."""
    months = [r[0] for r in rows.select("recorder_id", MONTH).join(changed, "recorder_id", "left_semi").select(MONTH).distinct().collect()]
    return rows.where(F.col(MONTH).isin(months)).join(changed, "recorder_id", "left_semi")


def _keep_waiting(parties: DataFrame, fact: DataFrame, changed: DataFrame | None, place: str) -> None:
    """Parties without a transaction wait; those of changed transactions do so no longer if it has come."""
    left = parties.where("recorder_id IS NOT NULL").join(fact.select("recorder_id"), "recorder_id", "left_anti")
    if changed is None:
        merge_buckets(left, place, ["recorder_id"], lambda _, rows: rows, whole=True)
        return
    # a changed transaction without waiting parties is named by a row that only clears
    named = changed.join(left, "recorder_id", "left")

    def merge(current: DataFrame | None, rows: DataFrame) -> DataFrame:
        stay = rows.where("role IS NOT NULL")
        return stay if current is None else current.join(rows.select("recorder_id"), "recorder_id", "left_anti").unionByName(stay)

    merge_buckets(named, place, ["recorder_id"], merge)


def _load_owners(spark: SparkSession, model_base: str, fact: DataFrame, bridge: DataFrame, changed: DataFrame | None) -> int:
    """Owners of all properties, or of those that changed transactions bear on; returns the rows written."""
    place = f"{model_base}/bridge_property_owner"
    owned = ["property_key", "entity_key", "transaction_key"]
    if changed is None:
        owners = staged(model.build_bridge_property_owner(fact, bridge, ["transaction_key"]).select(*owned), "owners")
        merge_buckets(owners, place, ["property_key"], lambda _, rows: rows, whole=True)
        return owners.count()
    known = read_buckets(spark, place)
    was = known.join(fact.select("transaction_key"), "transaction_key", "left_semi").select("property_key")
    touched = fact.where("property_key IS NOT NULL").select("property_key").union(was).distinct()
    touched = staged(touched, "changed-properties")
    facts = read_partitions(spark, f"{model_base}/fact_transaction", MONTH).join(touched, "property_key", "left_semi")
    sales = staged(model.latest_sales(facts, [MONTH]), "latest-sales")
    months = [r[0] for r in sales.select(MONTH).distinct().collect()]
    parties = read_partitions(spark, f"{model_base}/bridge_transaction_party", MONTH).where(F.col(MONTH).isin(months))
    owners = parties.where((F.col("party_role") == "grantee") & F.col("entity_key").isNotNull())
    owners = owners.join(sales.select("transaction_key", "property_key"), "transaction_key").select(*owned).distinct()
    named = staged(touched.join(owners, "property_key", "left"), "owners")

    def merge(current: DataFrame | None, rows: DataFrame) -> DataFrame:
        stay = rows.where("entity_key IS NOT NULL")
        return stay if current is None else current.join(rows.select("property_key"), "property_key", "left_anti").unionByName(stay)

    merge_buckets(named, place, ["property_key"], merge)
    return named.where("entity_key IS NOT NULL").count()
