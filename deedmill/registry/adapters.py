"""The shared test tables in the shapes of the domain.

The tables hold no NULLs, repeats or orphans, so the cases the operators are
about are derived from column values here, and in the same way in ``oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deedmill import schemas
from deedmill.functions.deals import classify_transaction, is_sale
from deedmill.operators.skew import lookup_left
from deedmill.schemas import Feed

FEED = Feed("feed")
USE_CODES = ["BUILDING", "HOUSEHOLD"]
#: Shares for each core when rows are dealt over the cluster: some to even out, few enough for files of some size.
SHARES_PER_CORE = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


# ---- transactions ------------------------------------------------------------

TRANSACTION = {
    "recorder_id": "cast(o_orderkey as string)",
    "tax_assessor_id": """case when o_orderkey % 13 = 0 then null when o_orderkey % 19 = 0 then ''
        else cast(o_custkey as string) end""",
    "document_recorded_date": "cast(o_orderdate as date)",
    "document_instrument_date": "date_sub(cast(o_orderdate as date), 3)",
    "document_number_formatted": "concat('D-', cast(o_orderkey as string))",
    "document_type_code": "substring(o_orderpriority, 1, 1)",
    "document_amount": """case when o_orderkey % 10 = 0 then cast(0 as decimal(18,2))
        when o_orderkey % 17 = 0 then null else cast(o_totalprice as decimal(18,2)) end""",
    "transfer_tax_amount": "cast(floor(o_totalprice) as decimal(18,2))",
    "arms_length_code": "case o_orderstatus when 'P' then null when 'O' then '' else o_orderstatus end",
    "inter_family_flag": "case o_orderkey % 4 when 0 then null when 1 then '' when 2 then 'N' else 'Y' end",
    "is_foreclosure_auction_sale": "case o_orderkey % 5 when 0 then null when 1 then '0' else '' end",
    "is_quit_claim": "case o_custkey % 3 when 0 then null when 1 then '' else '1' end",
    "new_construction_flag": "case o_custkey % 2 when 0 then 'true' end",
    "resale_flag": "case o_custkey % 2 when 1 then 'false' else '' end",
    "property_address": "concat(cast(o_custkey as string), ' Main St')",
    "property_city": "concat('City ', cast(o_custkey % 50 as string))",
    "property_state": "concat('S', cast(o_custkey % 7 as string))",
    "property_zip": "cast(10000 + o_custkey % 500 as string)",
    FEED.ingest_column: "cast(cast(o_orderdate as date) as string)",
}


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat typed transactions, one per order."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(*[F.expr(sql).alias(name) for name, sql in TRANSACTION.items()])


def party_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties per transaction, from the lines: all name a buyer, returned ones a seller too."""
    counts = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count_if(F.col("l_returnflag") != "N").alias("grantor_count"),
            F.count(F.lit(1)).alias("grantee_count"),
        )
    )
    return counts.select(text("l_orderkey").alias("recorder_id"), "grantor_count", "grantee_count")


def counted_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).join(party_counts(spark, sf_dir), "recorder_id", "left")


def _elements(count: Column, most: int, element) -> Column:
    """Array of ``count`` (0 to ``most``) elements numbered from 1.

    One expression for all elements: written out for each, the row's code is too long to be compiled.
    """
    return F.transform(F.slice(F.array(*[F.lit(j) for j in range(1, most + 1)]), F.lit(1), count), element)


def _party(role: str, label: str):
    def element(j: Column) -> Column:
        code = F.element_at(
            F.array(*[F.lit(c) for c in ("C", "TRUST", "LLC", "P", "c", None)]),
            ((F.col("o_orderkey") + j) % 6 + 1).cast("int"),
        )
        number = text((F.col("o_custkey") + j) % 977)
        named = (F.col("o_orderkey") + j) % 11 != 0
        values = [
            F.concat(text("o_orderkey"), F.lit(f"-{role[-1]}"), text(j)),
            F.when(named, F.concat(F.lit(f"{label} "), number)),
            F.concat(F.lit("Box "), text(j)),
            code,
            F.when(j % 2 == 1, F.concat(F.lit("First"), number)),
            F.when(j % 3 != 0, F.concat(F.lit("Last"), number)),
        ]
        return F.struct(*[v.alias(n) for v, n in zip(values, FEED.party_fields(role))])

    return element


def _mortgage(j: Column) -> Column:
    given = j != 2
    values = {
        f"{FEED.name}_recorder_mortgage_pk": F.concat(text("o_orderkey"), F.lit("-m"), text(j)),
        "document_number": F.concat(F.lit("M-"), text("o_orderkey")),
        "type_code": F.col("o_orderpriority"),
        "amount": text(money("o_totalprice")),
        "lender_name": F.concat(F.lit("Bank "), text(F.col("o_custkey") % 40)),
    }
    return F.struct(
        *[F.when(given, values.get(n, F.lit(None).cast("string"))).alias(n) for n in FEED.mortgage_fields()]
    )


def nested_transactions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Transactions with nested parties and mortgages, as a feed lands them.

    With ``spread`` the orders are dealt over all cores before they grow wide: a
    file of few row groups would keep most of them idle.
    """
    orders = table(spark, sf_dir, "orders")
    if spread:
        orders = orders.repartition(SHARES_PER_CORE * spark.sparkContext.defaultParallelism)
    key = F.col("o_orderkey")
    count = lambda most: (key % (most + 1)).cast("int")
    return orders.select(
        *[F.expr(sql).alias(name) for name, sql in TRANSACTION.items()],
        F.when(key % 8 != 0, _elements(count(3), 3, _party("grantor", "Seller"))).alias(
            schemas.PARTY_ARRAY["grantor"]
        ),
        F.when(key % 9 != 0, _elements(count(2), 2, _party("grantee", "Buyer"))).alias(
            schemas.PARTY_ARRAY["grantee"]
        ),
        _elements(count(3), 3, _mortgage).alias(schemas.MORTGAGE_ARRAY),
    )


# ---- parties -----------------------------------------------------------------


def _spelled(name: str) -> Column:
    """The name in upper case, lower case or padded, by line."""
    n = F.col("l_linenumber") % 3
    return (
        F.when(n == 0, F.upper(name))
        .when(n == 1, F.lower(name))
        .otherwise(F.concat(F.lit("  "), F.col(name), F.lit(" \t")))
    )


def _line_pk(tag: str) -> Column:
    return F.concat(text("l_orderkey"), F.lit(f"-{tag}"), text("l_linenumber"))


def line_grantors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seller per line; those of lines that were not returned have no name."""
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    joined = lookup_left(
        lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"), suppliers, "l_suppkey", ["s_name"],
        F.col("l_suppkey").isNotNull(), F.struct("l_orderkey", "l_linenumber"),
    )
    return joined.select(
        text("l_orderkey").alias("recorder_id"),
        _line_pk("s").alias(FEED.party_key("grantor")),
        F.when(F.col("l_returnflag") != "N", _spelled("s_name")).alias("grantor_name"),
        F.lit(None).cast("string").alias("grantor_address"),
        F.lit("CORP").alias("grantor_entity_code"),
        F.lit(None).cast("string").alias("grantor_first_name"),
        F.lit(None).cast("string").alias("grantor_last_name"),
    )


PART_CODES = {"PROMO": "C", "LARGE": "TRUST", "SMALL": "LLC", "MEDIUM": "P", "ECONOMY": "c"}


def line_grantees(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    joined = lookup_left(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), parts, "l_partkey",
        ["p_name", "p_type"], F.col("l_partkey").isNotNull(), F.struct("l_orderkey", "l_linenumber"),
    )
    code = F.lit(None).cast("string")
    for kind, letter in PART_CODES.items():
        code = F.when(F.col("p_type") == kind, letter).otherwise(code)
    blank = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 7)
    words = F.split("p_name", " ")
    return joined.select(
        text("l_orderkey").alias("recorder_id"),
        _line_pk("p").alias(FEED.party_key("grantee")),
        F.when(blank, "").otherwise(_spelled("p_name")).alias("grantee_name"),
        F.lit(None).cast("string").alias("grantee_address"),
        code.alias("grantee_entity_code"),
        F.when(F.col("l_linenumber") % 2 == 0, words[0]).alias("grantee_first_name"),
        words[1].alias("grantee_last_name"),
    )


#: An owner per customer, and how every so manieth is written as well: (each, offset of the key, name).
OWNER = """concat(translate(substr(md5(cast(c_custkey as string)), 1, 10), '0123456789abcdef', 'bcdfghjklmnprstv'),
    case c_custkey % 4 when 0 then ' Holdings' when 1 then ' Partners' when 2 then ' Realty' else ' Capital' end,
    case c_custkey % 3 when 0 then ' LLC' when 1 then ' Inc.' else ' Trust' end)"""
MISSPELT = [
    (1, 0, "owner"),
    (3, 1, "concat(substr(owner, 1, 2), substr(owner, 4))"),
    (4, 2, "lower(concat(substr(owner, 1, 4), 'x', substr(owner, 6)))"),
    (6, 3, "concat(substr(owner, 1, 1), 'q', substr(owner, 2, 5), substr(owner, 8))"),
    (9, 4, "concat(substr(owner, 1, 2), substr(owner, 4, 1), 'x', substr(owner, 6))"),
    (5, 5, "concat(owner, ' ', cast(c_custkey % 2 as string))"),
    (7, 6, "concat('  ', replace(owner, ' ', '. '), '!')"),
    (31, 7, "substr(owner, 1, 3 + c_custkey % 2)"),
    (97, 8, "'--'"),
]


def misspelt_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with misspelt doubles."""
    owners = table(spark, sf_dir, "customer").select("c_custkey", F.expr(OWNER).alias("owner"))
    forms = [
        F.when(F.col("c_custkey") % each == 0, F.struct((F.col("c_custkey") + at * 1_000_000_000).alias("k"), F.expr(name).alias("name")))
        for each, at, name in MISSPELT
    ]
    rows = owners.select(F.explode(F.array(*forms)).alias("f")).where("f IS NOT NULL")
    return rows.select(F.col("f.k").alias("entity_key"), F.col("f.name").alias("canonical_entity_name"))


# ---- properties --------------------------------------------------------------

PROPERTY = {
    "tax_assessor_id": "cast(c_custkey as string)",
    "assessor_parcel_number_raw": "c_name",
    "address": "case when c_custkey % 4 = 0 then '' else concat(cast(c_custkey as string), ' Main St') end",
    "city": "concat('City ', cast(c_custkey % 50 as string))",
    "state": "concat('S', cast(c_custkey % 7 as string))",
    "zip": "cast(10000 + c_custkey % 500 as string)",
    "situs_county": "concat('County ', cast(c_nationkey as string))",
    "property_use_standardized_code": "c_mktsegment",
    "year_built": "cast(1900 + c_custkey % 120 + {version} as string)",
    "building_sq_ft": """case when c_custkey % 11 = 0 then 'n/a' when c_custkey % 23 = 0 then 'NaN'
        else cast(500 + c_custkey % 9000 as string) end""",
    "lot_size_sq_ft": """case when c_custkey % 29 = 0 then '99999999999' when c_custkey % 31 = 0 then '1e400'
        else cast(1000 + c_custkey % 20000 as string) end""",
    "units_count": "cast(c_custkey % 300 as string)",
    "assessed_value_total": "cast(cast(c_acctbal + {version} as decimal(18,2)) as string)",
    "market_value_total": "cast(cast(c_acctbal * 2 as decimal(18,2)) as string)",
    "latitude": "cast(c_nationkey + 0.5 as string)",
    "longitude": "cast(-(c_custkey % 90) - 0.25 as string)",
}


def property_records(spark: SparkSession, sf_dir: str, version: int = 0) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        *[F.expr(sql.format(version=version)).alias(name) for name, sql in PROPERTY.items()]
    )


def raw_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enveloped property documents: all once, the valuable again a month later.

    Every seventh has its id only in the document, every 97th nowhere.
    """
    customers = table(spark, sf_dir, "customer")
    loads = []
    for version, day, wanted in ((0, "2025-01-01", F.lit(True)), (1, "2025-02-01", F.col("c_acctbal") > 5000)):
        record = [F.expr(sql.format(version=version)).alias(n) for n, sql in PROPERTY.items()]
        nowhere = F.col("c_custkey") % 97 == 0
        record[0] = F.when(~nowhere, text("c_custkey")).alias("tax_assessor_id")
        outside = F.when((F.col("c_custkey") % 7 != 0) & ~nowhere, text("c_custkey"))
        loads.append(
            customers.where(wanted).select(
                outside.alias("tax_assessor_id"),
                F.to_json(F.struct(*record), {"ignoreNullFields": "false"}).alias("data"),
                F.lit(day).cast("timestamp").alias("extracted_at"),
            )
        )
    return loads[0].unionByName(loads[1])


def property_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four states of every property in time, some equal to the one before; every fifth has none."""
    v = F.col("v")
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(key % 5 != 0).select("*", F.explode(F.array(*map(F.lit, range(4)))).alias("v")).select(
        text("c_custkey").alias("tax_assessor_id"),
        F.date_add(F.lit("1992-01-01").cast("date"), (key * 37 % 500 + v * 500).cast("int")).alias("since"),
        F.concat(F.col("c_mktsegment"), F.lit("-"), text((key + F.floor(v / 2)) % 3)).alias("property_use_code"),
        (key % 300 + F.floor(v / 3)).cast("int").alias("units_count"),
    )


def property_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A property dimension keyed by customer, for lookups (multifamily only)."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment").isin(USE_CODES))
        .select(
            text("c_custkey").alias("tax_assessor_id"),
            (F.col("c_custkey") + 1).alias("property_key"),
            F.lit(True).alias("is_current"),
        )
    )


# ---- files and series --------------------------------------------------------


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("property_id"),
        F.concat(F.lit("Market "), text(F.col("user_id") % 9)).alias("market_name"),
        F.col("event_type").alias("series"),
        F.col("ts").alias("record_date"),
        F.col("value").alias("record_values"),
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("property_id"),
        text("c_custkey").alias("tax_assessor_id"),
        F.col("c_name").alias("identifier"),
        text(10000 + F.col("c_custkey") % 500).alias("zip"),
        F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("active_flag"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("property_name"),
        F.col("l_linenumber").alias("zip"),
        F.year("l_shipdate").alias("loan_origination_date"),
        F.col("l_returnflag").alias("loan_maturity_date"),
        F.col("l_linestatus").alias("loan_status"),
        F.col("l_quantity").alias("loan_amount(MM)"),
        text("l_suppkey").alias("lender"),
        text("l_partkey").alias("originator"),
        F.col("l_partkey").alias("property_id"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


LOAN_TIEBREAK = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "loan_amount(MM)"]


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures per area and vintage: customers of a nation and their orders of a year."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    placed = lookup_left(
        orders, customers, "o_custkey", ["c_nationkey"], F.col("o_custkey").isNotNull(), F.col("o_orderkey")
    )
    return placed.groupBy(
        text("c_nationkey").alias("geography_code"),
        F.concat(text(F.year("o_orderdate")), F.lit("A")).alias("vintage"),
    ).agg(
        F.count(F.lit(1)).alias("household_count"),
        F.sum(money("o_totalprice")).alias("total_income"),
    )


# ---- quality tables ----------------------------------------------------------


def quality_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties with repeated keys, empty ids and stale rows."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 50 == 1, key - 1).otherwise(key).alias("property_key"),
        F.when(key % 97 == 0, None).when(key % 89 == 0, "").otherwise(text(key - key % 40 % 2)).alias(
            "tax_assessor_id"
        ),
        F.lit("2025-01-01").cast("date").alias("valid_from"),
        (key % 3 != 0).alias("is_current"),
        F.col("c_mktsegment").alias("property_use_code"),
        F.when(key % 4 == 0, "").otherwise(F.col("c_name")).alias("property_address"),
    )


def quality_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(key % 10 == 1, None).otherwise(key).alias("entity_key"),
        F.concat(F.lit("feed::"), F.upper("s_name")).alias("canonical_entity_id"),
        F.when(key % 8 == 0, "").otherwise(F.col("s_name")).alias("canonical_entity_name"),
    )


def quality_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = counted_transactions(spark, sf_dir)
    key = F.col("recorder_id").cast("long")
    arms, amount = F.col("arms_length_code"), F.col("document_amount")
    return rows.select(
        key.alias("transaction_key"),
        F.when(key % 100 == 7, text(key - 1)).otherwise(F.col("recorder_id")).alias("recorder_id"),
        F.when(key % 3 == 0, F.col("tax_assessor_id").try_cast("long") + key % 2 * 100_000_000).alias(
            "property_key"
        ),
        F.when(key % 41 != 0, F.col("document_recorded_date")).alias("transaction_date"),
        F.col("document_amount"),
        classify_transaction(arms, amount).alias("transaction_category"),
        (is_sale(arms, amount) | (key % 170 == 0)).alias("is_sale"),
        F.coalesce("grantor_count", F.lit(0)).alias("grantor_count"),
        F.coalesce("grantee_count", F.lit(0)).alias("grantee_count"),
    )


def quality_bridge_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines are grantors, so the totals agree with the fact."""
    line = F.col("l_linenumber")
    orphan = (line == 6) & (F.col("l_returnflag") == "R")
    return table(spark, sf_dir, "lineitem").select(
        F.when(orphan, -F.col("l_orderkey") - 1).otherwise(F.col("l_orderkey")).alias("transaction_key"),
        F.when(F.col("l_returnflag") != "N", "grantor").otherwise("grantee").alias("party_role"),
        F.when((line == 5) & (F.col("l_returnflag") == "A"), "").otherwise(text("l_suppkey")).alias(
            "party_name_raw"
        ),
    )


def quality_bridge_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("property_key"), (F.col("o_orderkey") % 120).alias("entity_key")
    )
