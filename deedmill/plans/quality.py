"""Data-quality suite.

Every table is read once for all its row-wise checks: the metrics are one
aggregate, and the one-row result is turned into check rows. Set-like checks
(uniqueness, key membership) count per key first, as one aggregate with many
distinct columns would multiply every row.

A check that does not apply (an empty table, say) gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.functions import scoring
from deedmill.functions.deals import USE_CODES
from deedmill.functions.truth import truthy
from deedmill.operators.aggregates import count_if, share_of_total
from deedmill.operators.joins import fk_counts
from deedmill.session import staged

# --- fixed values: categories and texts of the report ------------------------
REQUIRED = "REQUIRED_FIELD"
UNIQUE = "UNIQUENESS"
INTEGRITY = "REFERENTIAL_INTEGRITY"
CONSISTENT = "CONSISTENCY"
BUSINESS = "BUSINESS_LOGIC"
COVERAGE = "COVERAGE"
COMPLETE = "COMPLETENESS"
CARDINALITY = "CARDINALITY"
TRANSACTION_TYPE = "TRANSACTION_TYPE"
CHECK_CATEGORIES = [REQUIRED, UNIQUE, INTEGRITY, CONSISTENT, BUSINESS]
NATURAL_KEY_NOTE = "SCD Type 2 natural key must be unique"
UNKNOWN = "UNKNOWN"
NO_KEY_NOTE = "Expected: most transactions don't match MF properties"
FULL, MOST = 100, 95
# --- end of fixed values -----------------------------------------------------

CHECK_COLUMNS = ["seq", "category", "check", "status", "passed", "total", "pct", "percentage", "message"]
STAT_COLUMNS = ["seq", "category", "metric", "value", "description"]


@dataclass(frozen=True)
class Tables:
    """Tables under test; one that is missing counts as empty."""

    dim_property: DataFrame
    dim_entity: DataFrame
    fact_transaction: DataFrame
    bridge_transaction_party: DataFrame | None = None
    bridge_property_owner: DataFrame | None = None


@dataclass(frozen=True)
class Check:
    seq: int
    category: str
    name: str
    passed: Column
    total: Column
    threshold: int = FULL
    message: Column | None = None
    applies: Column | None = None


def score(counts: DataFrame) -> DataFrame:
    """Report rows from rows of passed / total / threshold."""
    scored = counts.withColumn("pct", scoring.percent(F.col("passed"), F.col("total"))).withColumns(
        {
            "status": scoring.status(F.col("pct"), F.col("threshold")),
            "percentage": scoring.percent_text(F.col("pct")),
        }
    )
    return scored.select(*CHECK_COLUMNS)


def check_rows(metrics: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Check rows, not scored yet, from a one-row frame of metrics."""
    structs = [
        F.struct(
            F.lit(c.seq).alias("seq"),
            F.lit(c.category).alias("category"),
            F.lit(c.name).alias("check"),
            c.passed.cast("long").alias("passed"),
            c.total.cast("long").alias("total"),
            F.lit(c.threshold).alias("threshold"),
            (F.lit("") if c.message is None else c.message).alias("message"),
            (F.lit(True) if c.applies is None else c.applies).alias("applies"),
        )
        for c in checks
    ]
    return metrics.select(F.inline(F.array(*structs))).where("applies")


def stat_rows(metrics: DataFrame, stats: Sequence[tuple[int, str, str, Column, str, Column]]) -> DataFrame:
    """Statistic rows from a one-row frame: (seq, category, metric, value, description, applies)."""
    structs = [
        F.struct(
            F.lit(seq).alias("seq"),
            F.lit(category).alias("category"),
            F.lit(metric).alias("metric"),
            value.alias("value"),
            F.lit(description).alias("description"),
            applies.alias("applies"),
        )
        for seq, category, metric, value, description, applies in stats
    ]
    return metrics.select(F.inline(F.array(*structs))).where("applies").select(*STAT_COLUMNS)


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


_rows = lambda: F.count(F.lit(1)).alias("rows")
_any = lambda: F.col("rows") > 0


def _filled(df: DataFrame, name: str, metric: str) -> Column:
    return count_if(truthy(df, name)).alias(metric)


def _property_metrics(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    return df.agg(
        _rows(),
        _filled(df, "tax_assessor_id", "tax_ok"),
        _filled(df, "valid_from", "valid_ok"),
        count_if(F.col("is_current")).alias("current"),
        count_if(F.col("property_use_code").isin(list(codes))).alias("code_ok"),
        _filled(df, "property_address", "address_ok"),
    )


def _fact_metrics(df: DataFrame, start, end) -> DataFrame:
    return df.agg(*_fact_aggregates(df, start, end))


def _fact_aggregates(df: DataFrame, start, end) -> list[Column]:
    dated = truthy(df, "transaction_date")
    day = F.when(dated, F.col("transaction_date").cast("date"))
    first, last = (F.lit(d).cast("date") for d in (start, end))
    sale = F.col("is_sale")
    grantors, grantees = (F.coalesce(F.col(c), F.lit(0)) for c in ("grantor_count", "grantee_count"))
    return [
        _rows(),
        _filled(df, "recorder_id", "recorder_ok"),
        count_if(dated).alias("dated"),
        count_if(sale).alias("sales"),
        count_if(sale & (F.col("document_amount") > 0)).alias("sales_ok"),
        count_if((grantors > 0) | (grantees > 0)).alias("party_ok"),
        count_if(grantors >= 2).alias("many_grantors"),
        count_if(grantees >= 2).alias("many_grantees"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        count_if(day.between(first, last)).alias("in_range"),
        F.coalesce(F.sum(grantors), F.lit(0)).alias("grantors"),
    ]


# ---- required fields ---------------------------------------------------------


def _property_checks() -> list[Check]:
    tax, start = "dim_property.tax_assessor_id NOT NULL", "dim_property.valid_from NOT NULL"
    return [
        Check(1, REQUIRED, tax, F.col("tax_ok"), F.col("rows"), applies=_any()),
        Check(2, REQUIRED, start, F.col("valid_ok"), F.col("rows"), applies=_any()),
        Check(
            63, BUSINESS, "Properties have valid MF use codes",
            F.col("code_ok"), F.col("rows"), MOST, applies=_any(),
        ),
    ]


def _entity_checks() -> list[Check]:
    ident, name = "dim_entity.canonical_entity_id NOT NULL", "dim_entity.canonical_entity_name NOT NULL"
    return [
        Check(3, REQUIRED, ident, F.col("id_ok"), F.col("rows"), applies=_any()),
        Check(4, REQUIRED, name, F.col("name_ok"), F.col("rows"), applies=_any()),
    ]


def _fact_checks(start, end) -> list[Check]:
    span = F.concat(
        F.lit(f"Expected: {start} to {end}, Actual: "),
        F.col("min_date").cast("string"), F.lit(" to "), F.col("max_date").cast("string"),
    )
    checks = [
        Check(
            5, REQUIRED, "fact_transaction.recorder_id NOT NULL",
            F.col("recorder_ok"), F.col("rows"), applies=_any(),
        ),
        Check(
            6, REQUIRED, "fact_transaction.transaction_date NOT NULL",
            F.col("dated"), F.col("rows"), applies=_any(),
        ),
        Check(
            61, BUSINESS, "Sales have document_amount > 0",
            F.col("sales_ok"), F.col("sales"), applies=F.col("sales") > 0,
        ),
        Check(
            62, BUSINESS, "Transactions have at least one party",
            F.col("party_ok"), F.col("rows"), MOST, applies=_any(),
        ),
    ]
    if start and end:
        checks.append(
            Check(
                53, CONSISTENT, "Transactions within date range",
                F.col("in_range"), F.col("dated"), message=span, applies=F.col("dated") > 0,
            )
        )
    return checks


def _bridge_checks() -> list[Check]:
    name = "bridge_transaction_party.party_name_raw NOT NULL"
    return [Check(7, REQUIRED, name, F.col("name_ok"), F.col("rows"), applies=_any())]


def _only(checks: Sequence[Check], categories: Sequence[str]) -> list[Check]:
    return [c for c in checks if c.category in categories]


def row_checks(
    tables: Tables, categories: Sequence[str], start=None, end=None, codes: Sequence[str] = USE_CODES
) -> list[DataFrame]:
    """The row-wise checks of the categories, one pass per table."""
    entity, bridge = tables.dim_entity, tables.bridge_transaction_party
    planned = [
        (_property_checks(), lambda: _property_metrics(tables.dim_property, codes)),
        (
            _entity_checks(),
            lambda: entity.agg(
                _rows(),
                _filled(entity, "canonical_entity_id", "id_ok"),
                _filled(entity, "canonical_entity_name", "name_ok"),
            ),
        ),
        (_fact_checks(start, end), lambda: _fact_metrics(tables.fact_transaction, start, end)),
    ]
    if bridge is not None:
        planned.append(
            (_bridge_checks(), lambda: bridge.agg(_rows(), _filled(bridge, "party_name_raw", "name_ok")))
        )
    parts = []
    for checks, metrics in planned:
        wanted = _only(checks, categories)
        if wanted:
            parts.append(check_rows(metrics(), wanted))
    return parts


def check_required_fields(tables: Tables) -> DataFrame:
    return score(_stack(row_checks(tables, [REQUIRED])))


# ---- uniqueness --------------------------------------------------------------


def _unique(df: DataFrame, seq: int, name: str, columns: Sequence[str], note: str = "") -> DataFrame:
    """Distinct values against rows, from one count per value."""
    per_value = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    metrics = per_value.agg(
        F.count(F.lit(1)).alias("values"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")
    )
    return check_rows(metrics, [_unique_check(seq, name, note)])


def _unique_check(seq: int, name: str, note: str) -> Check:
    return Check(seq, UNIQUE, name, F.col("values"), F.col("rows"), message=F.lit(note), applies=_any())


# --- fixed values: key -> (seq, name, note) -----------------------------------
UNIQUE_KEYS = {
    "property_key": (21, "dim_property.property_key is unique", ""),
    "property": (22, "dim_property (tax_assessor_id, valid_from) is unique", NATURAL_KEY_NOTE),
    "entity_key": (23, "dim_entity.entity_key is unique", ""),
    "transaction_key": (24, "fact_transaction.transaction_key is unique", ""),
    "recorder_id": (25, "fact_transaction.recorder_id is unique", ""),
}
# --- end of fixed values -----------------------------------------------------


def _uniqueness(tables: Tables) -> list[DataFrame]:
    prop, entity, fact = tables.dim_property, tables.dim_entity, tables.fact_transaction
    columns = {
        "property_key": (prop, ["property_key"]),
        "property": (prop, ["tax_assessor_id", "valid_from"]),
        "entity_key": (entity, ["entity_key"]),
        "transaction_key": (fact, ["transaction_key"]),
        "recorder_id": (fact, ["recorder_id"]),
    }
    return [_unique(df, seq, name, keys, note) for (df, keys), (seq, name, note) in zip(columns.values(), UNIQUE_KEYS.values())]


def check_uniqueness(tables: Tables) -> DataFrame:
    return score(_stack(_uniqueness(tables)))


# ---- referential integrity ---------------------------------------------------


# --- fixed values: link -> (seq, name) ------------------------------------------
LINKS = {
    "fact_property": (41, "fact_transaction.property_key → dim_property"),
    "party_fact": (42, "bridge_transaction_party.transaction_key → fact_transaction"),
    "owner_property": (43, "bridge_property_owner.property_key → dim_property"),
    "owner_entity": (44, "bridge_property_owner.entity_key → dim_entity"),
}
# --- end of fixed values -----------------------------------------------------


def _membership(child: DataFrame, fk: str, parent: DataFrame, pk: str, link: str) -> DataFrame:
    return check_rows(fk_counts(child, fk, parent, pk), [_link_check(link)])


def _link_check(link: str) -> Check:
    """From ``matched`` and ``total`` child rows; for the properties of facts also all ``rows``."""
    seq, name = LINKS[link]
    matched, total = F.col("matched"), F.col("total")
    note = None
    if link == "fact_property":
        note = F.concat(
            matched.cast("string"), F.lit("/"), total.cast("string"), F.lit(" match ("),
            (F.col("rows") - total).cast("string"), F.lit(" NULL)"),
        )
    return Check(seq, INTEGRITY, name, matched, total, message=note, applies=total > 0)


def _property_links(tables: Tables) -> DataFrame:
    """Fact rows with a property key, how many of the keys exist, and all rows."""
    fact = tables.fact_transaction
    keyed = fact.where(truthy(fact, "property_key"))
    rows = fact.agg(F.count(F.lit(1))).scalar()
    links = fk_counts(keyed, "property_key", tables.dim_property, "property_key")
    return links.withColumn("rows", rows)


def _integrity(tables: Tables) -> list[DataFrame]:
    parts = [check_rows(_property_links(tables), [_link_check("fact_property")])]
    party, owner = tables.bridge_transaction_party, tables.bridge_property_owner
    if party is not None:
        parts.append(_membership(party, "transaction_key", tables.fact_transaction, "transaction_key", "party_fact"))
    if owner is not None:
        parts += [
            _membership(owner, "property_key", tables.dim_property, "property_key", "owner_property"),
            _membership(owner, "entity_key", tables.dim_entity, "entity_key", "owner_entity"),
        ]
    return parts


def check_referential_integrity(tables: Tables) -> DataFrame:
    return score(_stack(_integrity(tables)))


def coverage_statistic(tables: Tables) -> DataFrame:
    """Stands in for the property-key check when no fact row has a key."""
    return _coverage(_property_links(tables))


def _coverage(links: DataFrame) -> DataFrame:
    value = F.concat(F.lit("0/"), F.col("rows").cast("string"), F.lit(" (0.0%)"))
    return stat_rows(
        links,
        [
            (
                41, COVERAGE, "Transactions with property_key", value, NO_KEY_NOTE,
                (F.col("rows") > 0) & (F.col("total") == 0),
            )
        ],
    )


# ---- consistency -------------------------------------------------------------


def _one_current(dim_property: DataFrame) -> DataFrame:
    per_id = dim_property.groupBy("tax_assessor_id").agg(
        count_if(F.col("is_current")).alias("_current"), F.count(F.lit(1)).alias("_n")
    )
    metrics = per_id.agg(
        count_if(F.col("_current") > 0).alias("ids"),
        F.coalesce(F.sum("_current"), F.lit(0)).alias("current"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
    )
    return check_rows(metrics, [_one_current_check()])


def _one_current_check() -> Check:
    """From distinct ``ids`` of current rows, ``current`` rows and all ``rows``."""
    ids, current = F.col("ids"), F.col("current")
    note = F.when(
        ids != current, F.concat((current - ids).cast("string"), F.lit(" duplicates"))
    ).otherwise("OK")
    name = "dim_property: 1 current row per tax_assessor_id"
    total = F.greatest(current, F.lit(1))
    return Check(51, CONSISTENT, name, ids, total, message=note, applies=_any())


def _party_totals(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    totals = fact.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.coalesce("grantor_count", F.lit(0))), F.lit(0)).alias("grantors"),
        )
    ).scalar()
    metrics = bridge.agg(
        _rows(), count_if(F.col("party_role") == "grantor").alias("bridge_grantors")
    ).withColumn("fact", totals)
    return check_rows(metrics, [_party_totals_check()])


def _party_totals_check() -> Check:
    """From ``rows`` and ``bridge_grantors`` of the bridge, and ``rows`` and ``grantors`` of the ``fact``."""
    in_bridge, in_fact = F.col("bridge_grantors"), F.col("fact")["grantors"]
    note = F.concat(
        F.lit("Bridge: "), scoring.grouped(in_bridge), F.lit(", Fact: "), scoring.grouped(in_fact)
    )
    return Check(
        52, CONSISTENT, "bridge grantor count = fact.grantor_count sum",
        F.when(in_bridge == in_fact, in_fact).otherwise(0),
        F.greatest(in_fact, F.lit(1)),
        message=note,
        applies=_any() & (F.col("fact")["rows"] > 0),
    )


def _set_consistency(tables: Tables) -> list[DataFrame]:
    parts = [_one_current(tables.dim_property)]
    if tables.bridge_transaction_party is not None:
        parts.append(_party_totals(tables.fact_transaction, tables.bridge_transaction_party))
    return parts


def check_consistency(tables: Tables, start=None, end=None) -> DataFrame:
    return score(_stack([*_set_consistency(tables), *row_checks(tables, [CONSISTENT], start, end)]))


# ---- business rules and statistics -------------------------------------------


def check_business_logic(tables: Tables, codes: Sequence[str] = USE_CODES) -> DataFrame:
    return score(_stack(row_checks(tables, [BUSINESS], codes=codes)))


def collect_statistics(tables: Tables) -> DataFrame:
    fact = tables.fact_transaction
    shares = share_of_total(fact.select("transaction_category"), "transaction_category", UNKNOWN)
    return _statistics(_property_metrics(tables.dim_property, []), _fact_metrics(fact, None, None), shares)


def _statistics(prop: DataFrame, fact: DataFrame, shares: DataFrame) -> DataFrame:
    """From the metrics of both tables and the shares of the categories."""
    share = lambda metric: scoring.share_text(F.col(metric), F.col("rows"))
    completeness = stat_rows(
        prop, [(71, COMPLETE, "dim_property.property_address", share("address_ok"), "", _any())]
    )
    cardinality = stat_rows(
        fact,
        [
            (72, CARDINALITY, "Transactions with 2+ grantors", share("many_grantors"), "", _any()),
            (73, CARDINALITY, "Transactions with 2+ grantees", share("many_grantees"), "", _any()),
        ],
    )
    return _stack([completeness, cardinality, _type_shares(shares)])


def _type_shares(shares: DataFrame) -> DataFrame:
    """A statistic for each ``transaction_category``, from its count ``n`` and ``pct`` of all."""
    return shares.select(
        F.lit(74).alias("seq"),
        F.lit(TRANSACTION_TYPE).alias("category"),
        F.concat("transaction_category", F.lit(" transactions")).alias("metric"),
        F.concat(
            scoring.grouped(F.col("n")), F.lit(" ("), scoring.percent_text(F.col("pct")), F.lit(")")
        ).alias("value"),
        F.lit("").alias("description"),
    )


# ---- the whole suite ---------------------------------------------------------


#: Types that keys are compared in.
_KEY = {"long": "long", "text": "string", "day": "date"}


def _key_rows(df: DataFrame, *roles: tuple) -> DataFrame:
    """Per row and role (domain, role, condition, key by type) a key, where the condition holds."""
    keys = []
    for domain, role, wanted, values in roles:
        typed = [F.col(values[k]).cast(t).alias(k) if k in values else F.lit(None).cast(t).alias(k) for k, t in _KEY.items()]
        key = F.struct(F.lit(domain).alias("domain"), F.lit(role).alias("role"), *typed)
        keys.append(key if wanted is None else F.when(wanted, key))
    return df.select(F.explode(F.array(*keys)).alias("k")).where("k IS NOT NULL").select("k.*")


def _key_metrics(tables: Tables) -> DataFrame:
    """One row per domain of keys: ``values`` and ``rows`` of the keys at home, and of
    two child tables, all ``rows`` and those ``matched``; all from one count per key."""
    fact, prop = tables.fact_transaction, tables.dim_property
    parts = [
        _key_rows(
            fact,
            ("transaction_key", "home", None, {"long": "transaction_key"}),
            ("recorder_id", "home", None, {"text": "recorder_id"}),
            ("property_key", "first", truthy(fact, "property_key"), {"long": "property_key"}),
        ),
        _key_rows(
            prop,
            ("property_key", "home", None, {"long": "property_key"}),
            ("property", "home", None, {"text": "tax_assessor_id", "day": "valid_from"}),
            ("current", "home", F.coalesce(F.col("is_current"), F.lit(False)), {"text": "tax_assessor_id"}),
        ),
        _key_rows(tables.dim_entity, ("entity_key", "home", None, {"long": "entity_key"})),
    ]
    if tables.bridge_transaction_party is not None:
        parts.append(_key_rows(tables.bridge_transaction_party, ("transaction_key", "first", None, {"long": "transaction_key"})))
    if tables.bridge_property_owner is not None:
        owner = tables.bridge_property_owner
        parts.append(
            _key_rows(owner, ("property_key", "second", None, {"long": "property_key"}), ("entity_key", "first", None, {"long": "entity_key"}))
        )
    of = lambda role: F.count_if(F.col("role") == role).alias(role)
    per_key = _stack(parts).groupBy("domain", *_KEY).agg(of("home"), of("first"), of("second"))
    at_home = lambda c: F.coalesce(F.sum(F.when(F.col("home") > 0, F.col(c))), F.lit(0))
    return per_key.groupBy("domain").agg(
        F.count_if(F.col("home") > 0).alias("values"),
        F.sum("home").alias("rows"),
        F.sum("first").alias("first"),
        at_home("first").alias("first_matched"),
        F.sum("second").alias("second"),
        at_home("second").alias("second_matched"),
    )


def validate_all(
    tables: Tables, start=None, end=None, codes: Sequence[str] = USE_CODES
) -> tuple[DataFrame, DataFrame]:
    """(checks, statistics) over all tables; ``seq`` gives the order of report.

    Every table is read twice at most: once for its row-wise metrics, which
    checks and statistics share, and once for its keys. All keys of all tables
    go through one exchange, where one count per key tells both whether it is
    unique and which of the rows that refer to it find it. The few rows of
    metrics are worked out here and kept.
    """
    fact, party = tables.fact_transaction, tables.bridge_transaction_party
    category = F.coalesce(F.col("transaction_category"), F.lit(UNKNOWN)).alias("transaction_category")
    by_category = staged(fact.groupBy(category).agg(*_fact_aggregates(fact, start, end)), "fact-metrics")
    merged = {"min_date": F.min("min_date"), "max_date": F.max("max_date")}
    names = [c for c in by_category.columns if c != "transaction_category"]
    facts = by_category.agg(*[merged.get(c, F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in names])
    entity = tables.dim_entity
    props = staged(_property_metrics(tables.dim_property, codes), "property-metrics")
    entities = entity.agg(_rows(), _filled(entity, "canonical_entity_id", "id_ok"), _filled(entity, "canonical_entity_name", "name_ok"))
    keys = staged(_key_metrics(tables), "key-metrics")

    def domain(name: str, **metrics: str) -> DataFrame:
        """One row, zeros if there is no such key at all."""
        rows = keys.where(F.col("domain") == name)
        return rows.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(n) for n, c in metrics.items()])

    rows_of_fact = facts.select("rows").scalar()
    links = domain("property_key", matched="first_matched", total="first").withColumn("rows", rows_of_fact)
    current = domain("current", ids="values", current="rows").withColumn("rows", props.select("rows").scalar())
    parts = [
        check_rows(props, _property_checks()),
        check_rows(entities, _entity_checks()),
        check_rows(facts, _fact_checks(start, end)),
        *[check_rows(domain(k, values="values", rows="rows"), [_unique_check(*v)]) for k, v in UNIQUE_KEYS.items()],
        check_rows(links, [_link_check("fact_property")]),
        check_rows(current, [_one_current_check()]),
    ]
    if party is not None:
        grantors = count_if(F.col("party_role") == "grantor").alias("bridge_grantors")
        bridged = staged(party.agg(_rows(), _filled(party, "party_name_raw", "name_ok"), grantors), "party-metrics")
        totals = facts.select(F.struct("rows", "grantors")).scalar()
        parts += [
            check_rows(bridged, _bridge_checks()),
            check_rows(domain("transaction_key", matched="first_matched", total="first"), [_link_check("party_fact")]),
            check_rows(bridged.withColumn("fact", totals), [_party_totals_check()]),
        ]
    if tables.bridge_property_owner is not None:
        parts += [
            check_rows(domain("property_key", matched="second_matched", total="second"), [_link_check("owner_property")]),
            check_rows(domain("entity_key", matched="first_matched", total="first"), [_link_check("owner_entity")]),
        ]
    shares = by_category.select("transaction_category", F.col("rows").alias("n")).withColumn(
        "pct", F.col("n").cast("double") / rows_of_fact.cast("double") * 100
    )
    return score(_stack(parts)), _coverage(links).union(_statistics(props, facts, shares))


def report_rollup(checks: DataFrame) -> DataFrame:
    count = lambda status: count_if(F.col("status") == status)
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        count(scoring.PASS).alias("passed"),
        count(scoring.WARN).alias("warnings"),
        count(scoring.FAIL).alias("failed"),
    )


def failed_checks(checks: DataFrame) -> DataFrame:
    return checks.where(F.col("status") == scoring.FAIL).select("check", "percentage", "pct")
