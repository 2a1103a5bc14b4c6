"""Explicit schemas: source payloads, model tables, reports.

Number-like payload fields are read as text and converted with ``try_cast`` in
the plans: ``from_json`` turns a quoted number into NULL when the declared type
is numeric.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# --- fixed values: field names of the source payloads ------------------------
TRANSACTION_FIELDS = [
    "recorder_id",
    "tax_assessor_id",
    "document_recorded_date",
    "document_instrument_date",
    "document_number_formatted",
    "document_type_code",
    "document_amount",
    "transfer_tax_amount",
    "arms_length_code",
    "inter_family_flag",
    "is_foreclosure_auction_sale",
    "is_quit_claim",
    "new_construction_flag",
    "resale_flag",
    "property_address",
    "property_city",
    "property_state",
    "property_zip",
]
PROPERTY_FIELDS = [
    "tax_assessor_id",
    "assessor_parcel_number_raw",
    "address",
    "city",
    "state",
    "zip",
    "situs_county",
    "property_use_standardized_code",
    "year_built",
    "building_sq_ft",
    "lot_size_sq_ft",
    "units_count",
    "assessed_value_total",
    "market_value_total",
    "latitude",
    "longitude",
]
PARTY_ARRAY = {
    "grantor": "recorder_grantor_v2__recorder_id",
    "grantee": "recorder_grantee_v2__recorder_id",
}
NESTED_PARTY_PREFIX = "recorder_g"
MORTGAGE_ARRAY = "recorder_mortgage_v2__recorder_id"
OWNER_ARRAY = "tax_assessor_owner_v2__tax_assessor_id"
UNMASK_ARRAY = "usa_owner_unmask_v2__tax_assessor_id"
# --- end of fixed values -----------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """The data supplier: its name tags keys, ids and the ingest-time column."""

    name: str = "feed"

    @property
    def ingest_column(self) -> str:
        return f"{self.name}_ingest_datetime"

    def party_key(self, role: str) -> str:
        return f"{self.name}_recorder_{role}_pk"

    def party_fields(self, role: str) -> list[str]:
        return [
            self.party_key(role),
            f"{role}_name",
            f"{role}_address",
            f"{role}_entity_code",
            f"{role}_first_name",
            f"{role}_last_name",
        ]

    def mortgage_fields(self) -> list[str]:
        return [
            f"{self.name}_recorder_mortgage_pk",
            "document_number",
            "document_recorded_date",
            "type_code",
            "amount",
            "lender_name",
            "term",
            "term_type_code",
            "mortgage_due_date",
            "interest_rate",
            "interest_rate_type_code",
            "is_adjustable_rate_rider",
            "has_pre_payment_penalty",
            "has_interest_only_period",
            self.ingest_column,
        ]

    def owner_fields(self) -> list[str]:
        return [
            f"{self.name}_tax_assessor_owner_pk",
            "owner_name",
            "owner_first_name",
            "owner_last_name",
            "owner_middle_name",
            "owner_name_suffix",
            "owner_type",
            "is_owner_company",
            "owner_trust_type_code",
            "ownership_vesting_relation_code",
            self.ingest_column,
        ]

    def unmask_fields(self) -> list[str]:
        return [
            f"{self.name}_usa_owner_unmask_pk",
            "owner_id",
            "owner_name",
            "owner_state",
            "owner_type",
            "has_confidence",
            "occurrences_count",
            "last_seen_date",
        ]


def text_struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def nested_transaction(feed: Feed) -> T.StructType:
    """Schema of landed nested transactions, party and mortgage arrays included."""
    schema = text_struct([*TRANSACTION_FIELDS, feed.ingest_column])
    for role, array in PARTY_ARRAY.items():
        schema = schema.add(array, T.ArrayType(text_struct(feed.party_fields(role))))
    return schema.add(MORTGAGE_ARRAY, T.ArrayType(text_struct(feed.mortgage_fields())))


def raw_transaction(feed: Feed) -> T.StructType:
    """Schema inside the ``data`` document of raw transactions."""
    return text_struct(
        [*TRANSACTION_FIELDS, feed.ingest_column, "grantor_count", "grantee_count"]
    )


def raw_party(feed: Feed, role: str) -> T.StructType:
    return text_struct(["recorder_id", *feed.party_fields(role)])


def raw_property() -> T.StructType:
    return text_struct(PROPERTY_FIELDS)


SNAPSHOT_PROPERTY = text_struct(
    [
        "property_id",
        "property_name",
        "address",
        "city",
        "county",
        "state",
        "zip",
        "units",
        "sqft",
        "completion_date",
        "latitude",
        "longitude",
        "latest_sale_date",
        "latest_sale_price($)",
        "owner",
        "owner_contact_first_name",
        "owner_contact_last_name",
        "owner_contact_email",
        "owner_contact_phone_number",
        "owner_address",
        "owner_city",
        "owner_state",
        "owner_zip",
        "owner_country",
    ]
)
LOAN_FILE = text_struct(
    [
        "property_id",
        "property_name",
        "zip",
        "loan_amount(MM)",
        "loan_origination_date",
        "loan_maturity_date",
        "loan_status",
        "lender",
        "originator",
    ]
)
SALE_FILE = text_struct(
    ["property_id", "property_name", "zip", "sale_date", "sale_price", "buyer", "seller"]
)
SERIES_FILE = text_struct(
    [
        "property_id",
        "property_name",
        "market_name",
        "submarket_name",
        "series",
        "record_date",
        "record_values",
    ]
)
MAPPING_FILE = text_struct(
    ["property_id", "tax_assessor_id", "identifier", "zip", "property_name", "active_flag", "insert_date"]
)
