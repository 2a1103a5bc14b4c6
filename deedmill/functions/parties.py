"""Party names and entity types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from deedmill.functions.truth import truthy_text

# --- fixed values ------------------------------------------------------------
# characters that count as surrounding white space
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ENTITY_CODES = {
    "CORPORATION": ["C", "CORP", "CORPORATION"],
    "TRUST": ["T", "TRUST"],
    "LLC": ["L", "LLC"],
    "PARTNERSHIP": ["P", "PARTNERSHIP"],
}
INDIVIDUAL = "INDIVIDUAL"
UNKNOWN = "UNKNOWN"
# --- end of fixed values -----------------------------------------------------


def normalize_name(name: Column) -> Column:
    """Upper case without surrounding white space of any kind."""
    return F.btrim(F.upper(name), F.lit(WHITE_SPACE))


def canonical_id(normalized: Column, supplier: str) -> Column:
    return F.concat(F.lit(f"{supplier}::"), normalized)


def classify_entity(code: Column, first_name: Column, last_name: Column) -> Column:
    """Entity type from its code, case-sensitive; people are known by both names."""
    personal = truthy_text(first_name) & truthy_text(last_name)
    kind = F.when(personal, INDIVIDUAL).otherwise(UNKNOWN)
    for label, codes in reversed(ENTITY_CODES.items()):
        kind = F.when(code.isin(codes), label).otherwise(kind)
    return kind


def name_fingerprint(name: Column) -> Column:
    """Match key: sorted distinct words of the name, punctuation dropped."""
    words = F.split(F.regexp_replace(F.upper(name), r"[^A-Z0-9]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), " ")
