"""The same queries in plain SQL over the same tables, written independently."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---- shared table expressions ------------------------------------------------

_TXN = """
txn AS (
  SELECT o_orderkey, o_custkey,
    CAST(o_orderkey AS VARCHAR) AS recorder_id,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ''
         ELSE CAST(o_custkey AS VARCHAR) END AS tax_assessor_id,
    CAST(o_orderdate AS DATE) AS document_recorded_date,
    CAST(o_orderdate AS DATE) - 3 AS document_instrument_date,
    'D-' || CAST(o_orderkey AS VARCHAR) AS document_number_formatted,
    substring(o_orderpriority, 1, 1) AS document_type_code,
    CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DECIMAL(18,2))
         WHEN o_orderkey % 17 = 0 THEN NULL
         ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS document_amount,
    CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS transfer_tax_amount,
    CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN '' ELSE o_orderstatus END AS arms_length_code,
    CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N' ELSE 'Y' END AS inter_family_flag,
    CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '0' ELSE '' END AS is_foreclosure_auction_sale,
    CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '1' END AS is_quit_claim,
    CASE o_custkey % 2 WHEN 0 THEN 'true' END AS new_construction_flag,
    CASE o_custkey % 2 WHEN 1 THEN 'false' ELSE '' END AS resale_flag,
    CAST(o_custkey AS VARCHAR) || ' Main St' AS property_address,
    'City ' || CAST(o_custkey % 50 AS VARCHAR) AS property_city,
    'S' || CAST(o_custkey % 7 AS VARCHAR) AS property_state,
    CAST(10000 + o_custkey % 500 AS VARCHAR) AS property_zip,
    strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS feed_ingest_datetime
  FROM orders)"""

_CLASS = """
classified AS (
  SELECT *,
    (arms_length_code IS NOT NULL AND arms_length_code <> '' AND document_amount IS NOT NULL
      AND document_amount > 0) AS is_sale,
    CASE WHEN arms_length_code <> '' AND document_amount > 0 THEN 'SALE'
         WHEN document_amount = 0 THEN 'MORTGAGE' ELSE 'OTHER' END AS transaction_category
  FROM txn)"""

_COUNTS = """
party_counts AS (
  SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag <> 'N') AS grantor_count, count(*) AS grantee_count
  FROM lineitem GROUP BY l_orderkey)"""

_SPELL = """CASE l_linenumber % 3 WHEN 0 THEN upper({n}) WHEN 1 THEN lower({n})
             ELSE '  ' || {n} || ' ' || chr(9) END"""

_PARTIES = f"""
parties AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS recorder_id, {_SPELL.format(n="s_name")} AS name,
    'CORP' AS entity_code, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
    'GRANTOR' AS role, l_orderkey || '-s' || l_linenumber AS source_pk, 0 AS role_rank
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag <> 'N'
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), {_SPELL.format(n="p_name")},
    CASE p_type WHEN 'PROMO' THEN 'C' WHEN 'LARGE' THEN 'TRUST' WHEN 'SMALL' THEN 'LLC'
                WHEN 'MEDIUM' THEN 'P' WHEN 'ECONOMY' THEN 'c' END,
    CASE WHEN l_linenumber % 2 = 0 THEN split_part(p_name, ' ', 1) END, split_part(p_name, ' ', 2),
    'GRANTEE', l_orderkey || '-p' || l_linenumber, 1
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE NOT (l_returnflag = 'N' AND l_linenumber = 7)),
named AS (
  SELECT *, trim(upper(name), ' ' || chr(9)) AS normalized,
    CASE WHEN entity_code IN ('C', 'CORP', 'CORPORATION') THEN 'CORPORATION'
         WHEN entity_code IN ('T', 'TRUST') THEN 'TRUST'
         WHEN entity_code IN ('L', 'LLC') THEN 'LLC'
         WHEN entity_code IN ('P', 'PARTNERSHIP') THEN 'PARTNERSHIP'
         WHEN first_name <> '' AND last_name <> '' THEN 'INDIVIDUAL'
         ELSE 'UNKNOWN' END AS entity_type
  FROM parties),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY normalized
    ORDER BY role_rank, recorder_id, source_pk, name, entity_code NULLS LAST, first_name NULLS LAST,
             last_name NULLS LAST) AS rn
  FROM named),
entities AS (
  SELECT row_number() OVER (ORDER BY 'feed::' || normalized) AS entity_key, *
  FROM ranked WHERE rn = 1)"""

_GRANTORS = """
grantors AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS recorder_id, o_orderkey, o_custkey, j
  FROM (SELECT o_orderkey, o_custkey, unnest(range(1, o_orderkey % 4 + 1)) AS j
        FROM orders WHERE o_orderkey % 8 <> 0))"""
_GRANTEES = """
grantees AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS recorder_id, o_orderkey, o_custkey, j
  FROM (SELECT o_orderkey, o_custkey, unnest(range(1, o_orderkey % 3 + 1)) AS j
        FROM orders WHERE o_orderkey % 9 <> 0))"""


def _exploded(role: str, label: str, tag: str) -> str:
    number = "CAST((o_custkey + j) % 977 AS VARCHAR)"
    return f"""
    SELECT recorder_id, o_orderkey || '-{tag}' || j AS feed_recorder_{role}_pk,
      CASE WHEN (o_orderkey + j) % 11 <> 0 THEN '{label} ' || {number} END AS {role}_name,
      'Box ' || j AS {role}_address,
      CASE (o_orderkey + j) % 6 WHEN 0 THEN 'C' WHEN 1 THEN 'TRUST' WHEN 2 THEN 'LLC' WHEN 3 THEN 'P'
           WHEN 4 THEN 'c' END AS {role}_entity_code,
      CASE WHEN j % 2 = 1 THEN 'First' || {number} END AS {role}_first_name,
      CASE WHEN j % 3 <> 0 THEN 'Last' || {number} END AS {role}_last_name
    FROM {role}s"""


_PROPS = """
props AS (
  SELECT c_custkey, version,
    CASE WHEN c_custkey % 97 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS tax_assessor_id,
    c_name AS assessor_parcel_number,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) || ' Main St' END AS property_address,
    'City ' || CAST(c_custkey % 50 AS VARCHAR) AS property_city,
    'S' || CAST(c_custkey % 7 AS VARCHAR) AS property_state,
    CAST(10000 + c_custkey % 500 AS VARCHAR) AS property_zip,
    'County ' || CAST(c_nationkey AS VARCHAR) AS property_county,
    c_mktsegment AS property_use_code,
    CAST(1900 + c_custkey % 120 + version AS INTEGER) AS year_built,
    CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 23 <> 0 THEN CAST(500 + c_custkey % 9000 AS INTEGER) END AS building_sqft,
    CASE WHEN c_custkey % 29 <> 0 AND c_custkey % 31 <> 0 THEN CAST(1000 + c_custkey % 20000 AS INTEGER) END AS land_sqft,
    CAST(c_custkey % 300 AS INTEGER) AS units_count,
    CAST(CAST(c_acctbal + version AS DECIMAL(18,2)) AS DOUBLE) AS assessed_value,
    CAST(CAST(c_acctbal * 2 AS DECIMAL(18,2)) AS DOUBLE) AS market_value,
    c_nationkey + 0.5::DOUBLE AS latitude,
    -(c_custkey % 90) - 0.25::DOUBLE AS longitude
  FROM customer, (SELECT 0 AS version UNION ALL SELECT 1)
  WHERE version = 0 OR c_acctbal > 5000)"""

_PROPERTY_DIM = """
property_dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS tax_assessor_id, c_custkey + 1 AS property_key
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD'))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_DAY = "'%Y-%m-%d'"
_TIME = "'%Y-%m-%d %H:%M:%S.%f'"

# ---- scans -------------------------------------------------------------------

ORACLE["scan_filter_project"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'"""

ORACLE["date_range_scan"] = f"""
SELECT o_orderkey, strftime(o_orderdate, {_TIME}) AS o_orderdate, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'"""

_FLAT = f"""recorder_id, tax_assessor_id,
  strftime(document_recorded_date, {_DAY}) AS document_recorded_date,
  strftime(document_instrument_date, {_DAY}) AS document_instrument_date,
  document_number_formatted, document_type_code,
  CAST(document_amount AS DOUBLE) AS document_amount, CAST(transfer_tax_amount AS DOUBLE) AS transfer_tax_amount,
  arms_length_code, inter_family_flag, is_foreclosure_auction_sale, is_quit_claim, new_construction_flag,
  resale_flag, property_address, property_city, property_state, property_zip, feed_ingest_datetime"""

ORACLE["nested_projection_toggle"] = f"""
{_with(_TXN)}
SELECT {_FLAT}, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 4 END AS grantors,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 3 END AS grantees FROM txn
UNION ALL
SELECT {_FLAT}, -1, -1 FROM txn"""

ORACLE["page_slice"] = f"""
SELECT strftime(d, {_TIME}) AS o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN orders.o_orderdate END AS d
  FROM orders ORDER BY d NULLS FIRST, o_orderkey LIMIT 450 OFFSET 450)"""

ORACLE["capped_scan"] = f"""
SELECT strftime(o_orderdate, {_TIME}) AS o_orderdate, o_orderkey FROM (
  SELECT * FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 1250)"""

ORACLE["distinct_ids"] = f"""
{_with(_TXN)}
SELECT DISTINCT tax_assessor_id FROM txn WHERE tax_assessor_id <> ''"""

ORACLE["keyed_lookup_scan"] = f"""
{_with(_TXN)}
SELECT CAST(c_custkey AS VARCHAR) AS tax_assessor_id, c_name AS assessor_parcel_number_raw,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) || ' Main St' END AS address,
  'City ' || CAST(c_custkey % 50 AS VARCHAR) AS city, 'S' || CAST(c_custkey % 7 AS VARCHAR) AS state,
  CAST(10000 + c_custkey % 500 AS VARCHAR) AS zip, 'County ' || CAST(c_nationkey AS VARCHAR) AS situs_county,
  c_mktsegment AS property_use_standardized_code, CAST(1900 + c_custkey % 120 AS VARCHAR) AS year_built,
  CASE WHEN c_custkey % 11 = 0 THEN 'n/a' WHEN c_custkey % 23 = 0 THEN 'NaN'
       ELSE CAST(500 + c_custkey % 9000 AS VARCHAR) END AS building_sq_ft,
  CASE WHEN c_custkey % 29 = 0 THEN '99999999999' WHEN c_custkey % 31 = 0 THEN '1e400'
       ELSE CAST(1000 + c_custkey % 20000 AS VARCHAR) END AS lot_size_sq_ft, CAST(c_custkey % 300 AS VARCHAR) AS units_count,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS assessed_value_total,
  CAST(CAST(c_acctbal * 2 AS DECIMAL(18,2)) AS VARCHAR) AS market_value_total,
  CAST(c_nationkey AS VARCHAR) || '.5' AS latitude,
  '-' || CAST(c_custkey % 90 AS VARCHAR) || '.25' AS longitude
FROM customer
WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
  AND EXISTS (SELECT 1 FROM txn WHERE txn.tax_assessor_id = CAST(c_custkey AS VARCHAR))"""

ORACLE["raw_envelope_roundtrip"] = """
SELECT user_id, event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS value_text, props,
  CAST(user_id AS VARCHAR) AS _user_id
FROM events"""

ORACLE["key_fallback"] = f"""
{_with(_PROPS)}
SELECT tax_assessor_id,
  CASE version WHEN 0 THEN '2025-01-01 00:00:00.000000' ELSE '2025-02-01 00:00:00.000000' END AS extracted_at
FROM props WHERE tax_assessor_id IS NOT NULL"""

# ---- nested rows -------------------------------------------------------------

ORACLE["flatten_party_counts"] = f"""
{_with(_TXN, _GRANTORS, _GRANTEES)},
s AS (SELECT o_orderkey, count(*) AS n FROM grantors GROUP BY 1),
b AS (SELECT o_orderkey, count(*) AS n FROM grantees GROUP BY 1)
SELECT recorder_id, CAST(document_amount AS DOUBLE) AS document_amount,
  CAST(coalesce(s.n, 0) AS INTEGER) AS grantor_count, CAST(coalesce(b.n, 0) AS INTEGER) AS grantee_count
FROM txn LEFT JOIN s USING (o_orderkey) LEFT JOIN b USING (o_orderkey)"""

ORACLE["explode_grantors"] = f"{_with(_GRANTORS)} {_exploded('grantor', 'Seller', 'r')}"
ORACLE["explode_grantees"] = f"{_with(_GRANTEES)} {_exploded('grantee', 'Buyer', 'e')}"

ORACLE["explode_mortgages"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS recorder_id, o_orderkey || '-m' || j AS feed_recorder_mortgage_pk,
  'M-' || o_orderkey AS document_number, o_orderpriority AS type_code,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  'Bank ' || CAST(o_custkey % 40 AS VARCHAR) AS lender_name
FROM (SELECT *, unnest(range(1, o_orderkey % 4 + 1)) AS j FROM orders)
WHERE j <> 2"""

_OWNED = """
owned AS (
  SELECT *, CAST(c_custkey AS VARCHAR) AS tax_assessor_id
  FROM customer, (SELECT 1 AS n UNION ALL SELECT 2)
  WHERE c_custkey % 5 <> 1 AND (n = 1 OR (c_custkey % 5 <> 0 AND c_custkey % 3 <> 0)))"""

ORACLE["explode_owners"] = f"""
{_with(_OWNED)}
SELECT tax_assessor_id, c_custkey || '-' || n AS feed_tax_assessor_owner_pk, c_name || ' ' || n AS owner_name,
  c_mktsegment AS owner_type
FROM owned"""

ORACLE["explode_unmask"] = f"""
{_with(_OWNED)}
SELECT tax_assessor_id, c_custkey || '-' || n AS feed_usa_owner_unmask_pk, c_custkey * 10 + n AS owner_id,
  c_acctbal > 0 AS has_confidence, CAST(c_nationkey + n AS INTEGER) AS occurrences_count
FROM owned"""

# ---- parties and entities ----------------------------------------------------

ORACLE["union_parties"] = f"""
{_with(_PARTIES)}
SELECT recorder_id, name, entity_code, first_name, last_name, role, source_pk FROM parties"""

ORACLE["normalize_name"] = f"""
{_with(_PARTIES)}
SELECT normalized, 'feed::' || normalized AS canonical_entity_id, count(*) AS n FROM named GROUP BY normalized"""

ORACLE["classify_entity"] = f"""
{_with(_PARTIES)}
SELECT entity_type, role, count(*) AS n FROM named GROUP BY entity_type, role"""

ORACLE["first_per_key"] = f"""
{_with(_PARTIES)}
SELECT normalized, name, role, recorder_id, source_pk FROM ranked WHERE rn = 1"""

ORACLE["dim_entity"] = f"""
{_with(_PARTIES)}
SELECT entity_key, 'feed::' || normalized AS canonical_entity_id, name AS canonical_entity_name, entity_type,
  CAST(NULL AS VARCHAR) AS state, 50 AS confidence_score, 1 AS occurrences_count, TRUE AS is_resolved,
  'name_normalization' AS resolution_method, '2025-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to,
  TRUE AS is_current, 'feed' AS source_system
FROM entities"""

ORACLE["entity_occurrences"] = f"""
{_with(_PARTIES)}
SELECT 'feed::' || normalized AS canonical_entity_id, count(*) AS occurrences_count FROM named GROUP BY 1"""

ORACLE["entity_identifiers"] = """
WITH e AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name),
spelled AS (
  SELECT k AS entity_key, p_name AS name FROM e
  UNION ALL SELECT k + 1000000, split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) FROM e
  UNION ALL SELECT k + 2000000, upper(p_name) || '.' FROM e),
marked AS (
  SELECT *, array_to_string(list_sort(list_distinct(regexp_extract_all(upper(name), '[A-Z0-9]+'))), ' ')
    AS identifier_value
  FROM spelled),
heads AS (
  SELECT identifier_value, min(entity_key) AS resolved_entity_key, arg_min(name, entity_key) AS head
  FROM marked GROUP BY 1)
SELECT entity_key, 'name_fingerprint' AS identifier_type, identifier_value, resolved_entity_key,
  CAST(levenshtein(upper(name), upper(head)) AS INTEGER) AS edits,
  levenshtein(upper(name), upper(head)) <= 4 AS is_match
FROM marked JOIN heads USING (identifier_value)"""

_CLEAN = r"trim(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"

ORACLE["fuzzy_identifiers"] = rf"""
WITH RECURSIVE o AS (
  SELECT c_custkey AS c, translate(substr(md5(CAST(c_custkey AS VARCHAR)), 1, 10), '0123456789abcdef', 'bcdfghjklmnprstv')
    || CASE c_custkey % 4 WHEN 0 THEN ' Holdings' WHEN 1 THEN ' Partners' WHEN 2 THEN ' Realty' ELSE ' Capital' END
    || CASE c_custkey % 3 WHEN 0 THEN ' LLC' WHEN 1 THEN ' Inc.' ELSE ' Trust' END AS owner
  FROM customer),
spelled AS (
  SELECT c AS entity_key, owner AS name FROM o
  UNION ALL SELECT c + 1000000000, substr(owner, 1, 2) || substr(owner, 4) FROM o WHERE c % 3 = 0
  UNION ALL SELECT c + 2000000000, lower(substr(owner, 1, 4) || 'x' || substr(owner, 6)) FROM o WHERE c % 4 = 0
  UNION ALL SELECT c + 3000000000, substr(owner, 1, 1) || 'q' || substr(owner, 2, 5) || substr(owner, 8) FROM o WHERE c % 6 = 0
  UNION ALL SELECT c + 4000000000, substr(owner, 1, 2) || substr(owner, 4, 1) || 'x' || substr(owner, 6) FROM o WHERE c % 9 = 0
  UNION ALL SELECT c + 5000000000, owner || ' ' || (c % 2) FROM o WHERE c % 5 = 0
  UNION ALL SELECT c + 6000000000, '  ' || replace(owner, ' ', '. ') || '!' FROM o WHERE c % 7 = 0
  UNION ALL SELECT c + 7000000000, substr(owner, 1, CAST(3 + c % 2 AS INTEGER)) FROM o WHERE c % 31 = 0
  UNION ALL SELECT c + 8000000000, '--' FROM o WHERE c % 97 = 0),
named AS (SELECT entity_key, {_CLEAN.format("upper(name)")} AS name FROM spelled),
heads AS (
  SELECT name, min(entity_key) AS head, trim(regexp_replace(name, '[^\p{{N}}]+', ' ', 'g')) AS numbers,
    list_sum(list_transform(list_distinct(list_transform(string_split(name, ''), lambda c: unicode(c) % 60)), lambda c: 1::BIGINT << c))::BIGINT AS letters
  FROM named WHERE name <> '' GROUP BY name),
pairs AS (
  -- all pairs; an edit adds one letter to those used and takes one away at most
  SELECT x.name AS a, y.name AS b
  FROM heads x JOIN heads y ON x.numbers = y.numbers AND x.name < y.name AND abs(length(x.name) - length(y.name)) <= 2
  WHERE CASE WHEN bit_count(xor(x.letters, y.letters)) <= 4 THEN levenshtein(x.name, y.name) ELSE 9 END
    <= least(2, least(length(x.name), length(y.name)) // 4)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT name, name AS other FROM heads
  UNION SELECT r.name, l.b FROM reach r JOIN links l ON l.a = r.other),
resolved AS (
  SELECT r.name, min(h.head) AS resolved_entity_key, arg_min(h.name, h.head) AS identifier_value
  FROM reach r JOIN heads h ON h.name = r.other GROUP BY r.name)
SELECT entity_key, 'name_edits' AS identifier_type, identifier_value, resolved_entity_key,
  (SELECT count(*) FROM links WHERE a = n.name) AS n_links,
  CAST(levenshtein(n.name, identifier_value) AS INTEGER) AS edits,
  n.name = identifier_value OR EXISTS (SELECT 1 FROM links WHERE a = n.name AND b = identifier_value) AS is_match
FROM named n JOIN resolved USING (name)"""

# ---- properties --------------------------------------------------------------

ORACLE["dim_property"] = f"""
{_with(_PROPS)},
newest AS (
  SELECT * FROM props WHERE tax_assessor_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY tax_assessor_id ORDER BY version DESC) = 1)
SELECT row_number() OVER (ORDER BY tax_assessor_id) AS property_key, tax_assessor_id, assessor_parcel_number,
  property_address, property_city, property_state, property_zip, property_county, property_use_code,
  CAST(NULL AS VARCHAR) AS land_use_code, year_built, building_sqft, land_sqft, units_count, assessed_value,
  market_value, latitude, longitude, '2025-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to,
  TRUE AS is_current, 'feed' AS source_system
FROM newest"""

ORACLE["latest_per_key"] = f"""
SELECT user_id, strftime(ts, {_TIME}) AS ts, event_type, props FROM (
  SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type, props) = 1)"""

ORACLE["surrogate_key"] = """
WITH known AS (SELECT c_name, c_custkey, c_custkey * 3 + 7 AS property_key FROM customer WHERE c_acctbal > 0)
SELECT property_key, c_name, c_custkey FROM known
UNION ALL
SELECT (SELECT max(property_key) FROM known) + row_number() OVER (ORDER BY c_name), c_name, c_custkey
FROM customer WHERE NOT c_acctbal > 0"""

ORACLE["dense_index"] = f"""
SELECT strftime(o_orderdate, {_TIME}) AS o_orderdate, o_orderkey,
  row_number() OVER (ORDER BY orders.o_orderdate, o_orderkey) AS idx
FROM orders"""

# ---- fact --------------------------------------------------------------------

_FACT = """
fact AS (
  SELECT c.*, p.property_key, coalesce(n.grantor_count, 0) AS grantors, coalesce(n.grantee_count, 0) AS grantees
  FROM classified c
  LEFT JOIN property_dim p ON c.tax_assessor_id = p.tax_assessor_id AND c.tax_assessor_id <> ''
  LEFT JOIN party_counts n ON n.l_orderkey = c.o_orderkey)"""

ORACLE["fact_transaction"] = f"""
{_with(_TXN, _CLASS, _COUNTS, _PROPERTY_DIM, _FACT)}
SELECT row_number() OVER (ORDER BY recorder_id) AS transaction_key, recorder_id, property_key,
  strftime(document_recorded_date, {_DAY}) AS transaction_date,
  strftime(document_instrument_date, {_DAY}) AS instrument_date,
  document_number_formatted AS document_number, document_type_code,
  CAST(document_amount AS DOUBLE) AS document_amount, CAST(transfer_tax_amount AS DOUBLE) AS transfer_tax_amount,
  transaction_category, is_sale,
  coalesce(arms_length_code <> '', FALSE) AS is_arms_length,
  coalesce(inter_family_flag <> '', FALSE) AS is_inter_family,
  coalesce(is_foreclosure_auction_sale <> '', FALSE) AS is_foreclosure,
  coalesce(is_quit_claim <> '', FALSE) AS is_quit_claim,
  coalesce(new_construction_flag <> '', FALSE) AS is_new_construction,
  coalesce(resale_flag <> '', FALSE) AS is_resale,
  CAST(grantors AS INTEGER) AS grantor_count, CAST(grantees AS INTEGER) AS grantee_count,
  property_address, property_city, property_state, property_zip, 'feed' AS source_system,
  feed_ingest_datetime || ' 00:00:00.000000' AS feed_ingest_datetime
FROM fact"""

_Q_PROPERTY = """
q_property AS (
  SELECT CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END AS property_key,
    CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN ''
         ELSE CAST(c_custkey - c_custkey % 40 % 2 AS VARCHAR) END AS tax_assessor_id,
    DATE '2025-01-01' AS valid_from, c_custkey % 3 <> 0 AS is_current, c_mktsegment AS property_use_code,
    CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS property_address
  FROM customer)"""

ORACLE["lookup_property_key"] = f"""
{_with(_TXN, _Q_PROPERTY)},
lookup AS (
  SELECT tax_assessor_id, max(property_key) AS property_key FROM q_property
  WHERE tax_assessor_id <> '' AND is_current GROUP BY 1)
SELECT recorder_id, property_key FROM txn LEFT JOIN lookup USING (tax_assessor_id)"""

_FLAGS = ["inter_family_flag", "is_foreclosure_auction_sale", "is_quit_claim", "new_construction_flag", "resale_flag"]
ORACLE["flag_truthiness"] = f"{_with(_TXN)} SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {f} <> '') AS {f}_python, "
    f"count(*) FILTER (WHERE lower({f}) NOT IN ('', 'n', 'no', 'f', 'false', '0')) AS {f}_yn"
    for f in _FLAGS
) + " FROM txn"

ORACLE["category_share"] = f"""
{_with(_TXN, _CLASS)}
SELECT transaction_category, count(*) AS n,
  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM txn) * 100 AS pct
FROM classified GROUP BY 1"""

ORACLE["party_cardinality"] = f"""
{_with(_COUNTS)}
SELECT grantor_count, count(*) AS n FROM party_counts GROUP BY 1"""

_REPRICED = """
source AS (
  SELECT l_partkey * 8 AS o_orderkey, l_extendedprice AS o_totalprice, strftime(l_shipdate, '%Y-%m') AS month
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1)"""

ORACLE["upsert_latest"] = f"""
{_with(_REPRICED)}
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders t
WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT s.o_orderkey, s.o_totalprice, t.o_orderpriority FROM source s LEFT JOIN orders t USING (o_orderkey)"""

ORACLE["upsert_months"] = f"""
{_with(_REPRICED)}
SELECT o_orderkey, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month FROM orders t
WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT s.o_orderkey, s.o_totalprice, t.o_orderpriority, s.month FROM source s LEFT JOIN orders t USING (o_orderkey)"""

ORACLE["load_sales"] = f"""
SELECT property_id, strftime(sale_date, {_DAY}) AS sale_date, sale_price, buyer, seller FROM (
  SELECT o_custkey AS property_id, CAST(o_orderdate AS DATE) AS sale_date,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS sale_price, o_orderpriority AS buyer,
    o_orderstatus AS seller
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate >= TIMESTAMP '1998-06-01' DESC, CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1)"""

ORACLE["scd2_history"] = f"""
WITH v AS (
  SELECT user_id, ts, event_type, value > 5 AS high FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_type, value > 5) = 1),
seen AS (
  SELECT *, lag(event_type) OVER w AS was_type, lag(high) OVER w AS was_high
  FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
changed AS (SELECT * FROM seen WHERE was_type IS NULL OR was_type <> event_type OR was_high <> high),
closed AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM changed)
SELECT user_id, event_type, high, strftime(ts, {_TIME}) AS valid_from,
  strftime(next_ts, {_TIME}) AS valid_to, next_ts IS NULL AS is_current
FROM closed"""

# ---- bridges -----------------------------------------------------------------

_BRIDGE = """
keyed AS (SELECT *, dense_rank() OVER (ORDER BY normalized) AS entity_key FROM named),
bridge AS (
  SELECT t.o_orderkey + 1 AS transaction_key, k.entity_key, lower(k.role) AS party_role, k.name AS party_name_raw
  FROM keyed k JOIN txn t ON t.recorder_id = k.recorder_id)"""

ORACLE["scd2_by_change"] = ORACLE["scd2_history"]

ORACLE["stored_pages"] = f"""
WITH placed AS (
  SELECT o_orderdate, o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place, count(*) OVER () AS n
  FROM orders),
parts AS (
  SELECT 'early' AS part, * FROM placed WHERE place >= 80 AND place < 120
  UNION ALL SELECT 'late', * FROM placed WHERE place >= n // 100 * 70 AND place < n // 100 * 70 + 70
  UNION ALL SELECT 'first', * FROM placed WHERE place < n // 3 + 11)
SELECT part, strftime(o_orderdate, {_TIME}) AS o_orderdate, o_orderkey, o_totalprice FROM parts"""

ORACLE["fact_as_of"] = f"""
{_with(_TXN)},
versions AS (
  SELECT CAST(c_custkey AS VARCHAR) AS tax_assessor_id, DATE '1992-01-01' + CAST(c_custkey * 37 % 500 + v * 500 AS INTEGER) AS since,
    c_mktsegment || '-' || CAST((c_custkey + v // 2) % 3 AS VARCHAR) AS property_use_code,
    CAST(c_custkey % 300 + v // 3 AS INTEGER) AS units_count
  FROM customer, range(4) r(v) WHERE c_custkey % 5 <> 0),
changes AS (
  SELECT * FROM versions
  WINDOW w AS (PARTITION BY tax_assessor_id ORDER BY since)
  QUALIFY lag(property_use_code) OVER w IS DISTINCT FROM property_use_code OR lag(units_count) OVER w IS DISTINCT FROM units_count),
dim AS (
  SELECT *, row_number() OVER (ORDER BY tax_assessor_id, since) AS property_key,
    lead(since) OVER (PARTITION BY tax_assessor_id ORDER BY since) AS until
  FROM changes)
SELECT t.recorder_id, t.tax_assessor_id, strftime(t.document_recorded_date, '%Y-%m-%d') AS document_recorded_date, d.property_key, d.property_use_code, d.units_count
FROM txn t LEFT JOIN dim d ON d.tax_assessor_id = t.tax_assessor_id AND t.document_recorded_date >= d.since
  AND (d.until IS NULL OR t.document_recorded_date < d.until)"""

ORACLE["bridge_transaction_party"] = f"{_with(_TXN, _PARTIES, _BRIDGE)} SELECT * FROM bridge"

ORACLE["bridge_property_owner"] = f"""
{_with(_TXN, _CLASS, _PARTIES, _BRIDGE, _PROPERTY_DIM)},
latest AS (
  SELECT p.property_key, CAST(c.recorder_id AS BIGINT) + 1 AS transaction_key
  FROM classified c JOIN property_dim p ON p.tax_assessor_id = c.tax_assessor_id
  WHERE c.is_sale
  QUALIFY row_number() OVER (PARTITION BY p.property_key
    ORDER BY c.document_recorded_date DESC, c.o_orderkey DESC) = 1)
SELECT DISTINCT property_key, entity_key FROM latest JOIN bridge USING (transaction_key)
WHERE party_role = 'grantee'"""

# ---- months, loads, audit ----------------------------------------------------

_MONTHS = """
ends AS (
  SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders),
months AS (
  SELECT strftime(m, '%Y-%m') AS month
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM ends))"""

ORACLE["month_series"] = f"{_with(_MONTHS)} SELECT month FROM months"

ORACLE["month_bounds"] = """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS start_date,
  strftime(last_day(o_orderdate), '%Y-%m-%d') AS end_date
FROM orders"""

ORACLE["valid_month"] = """
WITH w AS (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m')
    WHEN 1 THEN year(o_orderdate) || '-' || (o_orderkey % 20)
    WHEN 2 THEN strftime(o_orderdate, '%Y/%m')
    ELSE year(o_orderdate) || '-' || lpad(CAST(o_orderkey % 16 AS VARCHAR), 2, '0') END AS month_text
  FROM orders)
SELECT month_text,
  length(month_text) = 7 AND substring(month_text, 5, 1) = '-'
    AND try_cast(substring(month_text, 6, 2) AS INTEGER) BETWEEN 1 AND 12 AS is_valid, count(*) AS n
FROM w GROUP BY month_text"""

_LOG = """
by_month AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, month(o_orderdate) AS number, count(*) AS n
  FROM orders GROUP BY 1, 2)"""

ORACLE["backfill_load_log"] = f"""
{_with(_LOG)}
SELECT month, CASE WHEN number % 4 = 0 THEN 'failed' ELSE 'completed' END AS state,
  CAST(2 AS BIGINT) AS tries, CASE WHEN number % 4 <> 0 THEN n END AS rows
FROM by_month"""

ORACLE["pending_months"] = f"""
{_with(_MONTHS, _LOG)}
SELECT month FROM months
WHERE month NOT IN (SELECT month FROM by_month WHERE number % 4 <> 0)"""


def _landed(where: str, month: str | None) -> str:
    """Rows per raw table of the transactions that satisfy ``where``."""
    keyed = "strftime(o_orderdate, '%Y-%m') AS month, " if month else ""
    group = " GROUP BY 1" if month else ""
    return f"""
WITH picked AS (SELECT * FROM orders WHERE {where}),
ids AS (
  SELECT DISTINCT {keyed}o_custkey FROM picked WHERE o_orderkey % 13 <> 0 AND o_orderkey % 19 <> 0)
SELECT {keyed}count(*) AS n, 'transactions' AS raw_table FROM picked{group}
UNION ALL
SELECT {keyed}CAST(coalesce(sum(CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 4 END), 0) AS BIGINT), 'grantors'
FROM picked{group}
UNION ALL
SELECT {keyed}CAST(coalesce(sum(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 3 END), 0) AS BIGINT), 'grantees'
FROM picked{group}
UNION ALL
SELECT {keyed}CAST(coalesce(sum(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END), 0) AS BIGINT), 'mortgages'
FROM picked{group}
UNION ALL
SELECT {"month, " if month else ""}count(*), 'properties'
FROM ids JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD'){group}"""


ORACLE["backfill_months"] = f"""
SELECT * FROM ({_landed("month(o_orderdate) % 4 = 0", "month")}) WHERE n > 0"""
ORACLE["load_summary"] = _landed("year(o_orderdate) = 1997", None)

ORACLE["etl_audit"] = """
SELECT 'fact_transaction' AS table_name, 'analytics' AS schema_name, '2025-01-01' AS insert_date,
  count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2000-01-01') AS before_count, count(*) AS after_count,
  count(*) FILTER (WHERE NOT o_orderdate < TIMESTAMP '2000-01-01') AS new_rows
FROM orders"""

# ---- data quality ------------------------------------------------------------

_QUALITY = f"""
{_with(_TXN, _CLASS, _COUNTS, _Q_PROPERTY)},
q_entity AS (
  SELECT CASE WHEN s_suppkey % 10 <> 1 THEN s_suppkey END AS entity_key,
    'feed::' || upper(s_name) AS canonical_entity_id,
    CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE s_name END AS canonical_entity_name
  FROM supplier),
q_fact AS (
  SELECT o_orderkey AS transaction_key,
    CASE WHEN o_orderkey % 100 = 7 THEN CAST(o_orderkey - 1 AS VARCHAR) ELSE recorder_id END AS recorder_id,
    CASE WHEN o_orderkey % 3 = 0
         THEN try_cast(tax_assessor_id AS BIGINT) + o_orderkey % 2 * 100000000 END AS property_key,
    CASE WHEN o_orderkey % 41 <> 0 THEN document_recorded_date END AS transaction_date,
    document_amount, transaction_category, is_sale OR o_orderkey % 170 = 0 AS is_sale,
    coalesce(grantor_count, 0) AS grantor_count, coalesce(grantee_count, 0) AS grantee_count
  FROM classified LEFT JOIN party_counts ON l_orderkey = o_orderkey),
q_party AS (
  SELECT CASE WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN -l_orderkey - 1 ELSE l_orderkey END AS transaction_key,
    CASE WHEN l_returnflag <> 'N' THEN 'grantor' ELSE 'grantee' END AS party_role,
    CASE WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS party_name_raw
  FROM lineitem),
q_owner AS (SELECT o_custkey AS property_key, o_orderkey % 120 AS entity_key FROM orders)"""

_REQUIRED_SQL = [
    ("dim_property.tax_assessor_id NOT NULL", "q_property", "tax_assessor_id <> ''"),
    ("dim_property.valid_from NOT NULL", "q_property", "valid_from IS NOT NULL"),
    ("dim_entity.canonical_entity_id NOT NULL", "q_entity", "canonical_entity_id <> ''"),
    ("dim_entity.canonical_entity_name NOT NULL", "q_entity", "canonical_entity_name <> ''"),
    ("fact_transaction.recorder_id NOT NULL", "q_fact", "recorder_id <> ''"),
    ("fact_transaction.transaction_date NOT NULL", "q_fact", "transaction_date IS NOT NULL"),
    ("bridge_transaction_party.party_name_raw NOT NULL", "q_party", "party_name_raw <> ''"),
]
_REQUIRED = " UNION ALL ".join(
    f"SELECT 'REQUIRED_FIELD' AS category, '{name}' AS \"check\", count(*) FILTER (WHERE {ok}) AS passed, "
    f"count(*) AS total, 100 AS threshold, '' AS message FROM {src}"
    for name, src, ok in _REQUIRED_SQL
)

_UNIQUE_SQL = [
    ("dim_property.property_key is unique", "q_property", "property_key", ""),
    (
        "dim_property (tax_assessor_id, valid_from) is unique", "q_property", "tax_assessor_id, valid_from",
        "SCD Type 2 natural key must be unique",
    ),
    ("dim_entity.entity_key is unique", "q_entity", "entity_key", ""),
    ("fact_transaction.transaction_key is unique", "q_fact", "transaction_key", ""),
    ("fact_transaction.recorder_id is unique", "q_fact", "recorder_id", ""),
]
_UNIQUE = " UNION ALL ".join(
    f"SELECT 'UNIQUENESS' AS category, '{name}' AS \"check\", "
    f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {src})) AS passed, "
    f"(SELECT count(*) FROM {src}) AS total, 100 AS threshold, '{note}' AS message"
    for name, src, cols, note in _UNIQUE_SQL
)

_MATCHED = "count(*) FILTER (WHERE {fk} IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL))"
_FK = f"""
SELECT 'REFERENTIAL_INTEGRITY' AS category, 'fact_transaction.property_key → dim_property' AS "check", passed, total,
  100 AS threshold, passed || '/' || total || ' match (' || (n - total) || ' NULL)' AS message
FROM (SELECT {_MATCHED.format(fk="property_key", pk="property_key", parent="q_property")} AS passed,
        count(*) AS total, (SELECT count(*) FROM q_fact) AS n
      FROM q_fact WHERE property_key <> 0)
UNION ALL
SELECT 'REFERENTIAL_INTEGRITY', 'bridge_transaction_party.transaction_key → fact_transaction',
  {_MATCHED.format(fk="transaction_key", pk="transaction_key", parent="q_fact")}, count(*), 100, '' FROM q_party
UNION ALL
SELECT 'REFERENTIAL_INTEGRITY', 'bridge_property_owner.property_key → dim_property',
  {_MATCHED.format(fk="property_key", pk="property_key", parent="q_property")}, count(*), 100, '' FROM q_owner
UNION ALL
SELECT 'REFERENTIAL_INTEGRITY', 'bridge_property_owner.entity_key → dim_entity',
  {_MATCHED.format(fk="entity_key", pk="entity_key", parent="q_entity")}, count(*), 100, '' FROM q_owner"""

_CONSISTENCY = """
SELECT 'CONSISTENCY' AS category, 'dim_property: 1 current row per tax_assessor_id' AS "check", ids AS passed,
  greatest(n, 1) AS total, 100 AS threshold,
  CASE WHEN n <> ids THEN (n - ids) || ' duplicates' ELSE 'OK' END AS message
FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT tax_assessor_id FROM q_property WHERE is_current)) AS ids,
        (SELECT count(*) FROM q_property WHERE is_current) AS n)
UNION ALL
SELECT 'CONSISTENCY', 'bridge grantor count = fact.grantor_count sum', CASE WHEN b = f THEN f ELSE 0 END,
  greatest(f, 1), 100, 'Bridge: ' || format('{:,}', b) || ', Fact: ' || format('{:,}', f)
FROM (SELECT (SELECT count(*) FROM q_party WHERE party_role = 'grantor') AS b,
        (SELECT CAST(sum(grantor_count) AS BIGINT) FROM q_fact) AS f)
UNION ALL
SELECT 'CONSISTENCY', 'Transactions within date range',
  count(*) FILTER (WHERE transaction_date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31'),
  count(transaction_date), 100,
  'Expected: 1995-06-01 to 2000-12-31, Actual: ' || strftime(min(transaction_date), '%Y-%m-%d') || ' to '
    || strftime(max(transaction_date), '%Y-%m-%d')
FROM q_fact"""

_BUSINESS = """
SELECT 'BUSINESS_LOGIC' AS category, 'Sales have document_amount > 0' AS "check",
  count(*) FILTER (WHERE document_amount > 0) AS passed, count(*) AS total, 100 AS threshold, '' AS message
FROM q_fact WHERE is_sale HAVING count(*) > 0
UNION ALL
SELECT 'BUSINESS_LOGIC', 'Transactions have at least one party',
  count(*) FILTER (WHERE grantor_count > 0 OR grantee_count > 0), count(*), 95, '' FROM q_fact
UNION ALL
SELECT 'BUSINESS_LOGIC', 'Properties have valid MF use codes',
  count(*) FILTER (WHERE property_use_code IN ('BUILDING', 'HOUSEHOLD')), count(*), 95, '' FROM q_property"""


def _scored(*parts: str) -> str:
    return f"""
{_QUALITY},
counted AS ({" UNION ALL ".join(parts)}),
scored AS (
  SELECT *, CASE WHEN total > 0 THEN CAST(passed AS DOUBLE) / total * 100 ELSE 0 END AS pct FROM counted),
report AS (
  SELECT category, "check",
    CASE WHEN pct >= threshold THEN 'PASS' WHEN pct >= threshold - 15 THEN 'WARN' ELSE 'FAIL' END AS status,
    passed, total, pct, printf('%.1f%%', pct) AS percentage, message
  FROM scored)"""


for _name, _part in (
    ("dq_required", _REQUIRED),
    ("dq_unique", _UNIQUE),
    ("dq_fk", _FK),
    ("dq_consistency", _CONSISTENCY),
    ("dq_business", _BUSINESS),
):
    ORACLE[_name] = f"{_scored(_part)} SELECT * FROM report"

_REPORT = _scored(_REQUIRED, _UNIQUE, _FK, _CONSISTENCY, _BUSINESS)
ORACLE["dq_report"] = f"{_REPORT} SELECT * FROM report"
ORACLE["dq_rollup"] = f"""
{_REPORT}
SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
  count(*) FILTER (WHERE status = 'WARN') AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failed
FROM report"""
ORACLE["dq_failed"] = f"""{_REPORT} SELECT "check", percentage, pct FROM report WHERE status = 'FAIL'"""

_SHARE = """format('{{:,}}', {n}) || '/' || format('{{:,}}', count(*)) || ' ('
  || printf('%.1f%%', CAST({n} AS DOUBLE) / count(*) * 100) || ')'"""
ORACLE["dq_stats"] = f"""
{_QUALITY}
SELECT 'COMPLETENESS' AS category, 'dim_property.property_address' AS metric,
  {_SHARE.format(n="count(*) FILTER (WHERE property_address <> '')")} AS value, '' AS description FROM q_property
UNION ALL
SELECT 'CARDINALITY', 'Transactions with 2+ grantors',
  {_SHARE.format(n="count(*) FILTER (WHERE grantor_count >= 2)")}, '' FROM q_fact
UNION ALL
SELECT 'CARDINALITY', 'Transactions with 2+ grantees',
  {_SHARE.format(n="count(*) FILTER (WHERE grantee_count >= 2)")}, '' FROM q_fact
UNION ALL
SELECT 'TRANSACTION_TYPE', transaction_category || ' transactions',
  format('{{:,}}', count(*)) || ' (' ||
    printf('%.1f%%', CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM q_fact) * 100) || ')', ''
FROM q_fact GROUP BY transaction_category"""

ORACLE["dq_coverage"] = """
SELECT 'COVERAGE' AS category, 'Transactions with property_key' AS metric,
  '0/' || count(*) || ' (0.0%)' AS value,
  'Expected: most transactions don''t match MF properties' AS description
FROM orders"""

# ---- roll-ups and enrichment -------------------------------------------------

ORACLE["merge_snapshots"] = """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS snapshot, event_type, props, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) = 1"""

_LOANS = """
current_loans AS (
  SELECT *, year(l_shipdate) AS loan_origination_date FROM lineitem WHERE l_linestatus = 'O'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, year(l_shipdate), l_returnflag
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1)"""

ORACLE["clean_loans"] = f"""
{_with(_LOANS)}
SELECT l_orderkey AS property_name, l_linenumber AS zip, CAST(loan_origination_date AS INTEGER) AS loan_origination_date,
  l_returnflag AS loan_maturity_date, l_quantity * 1000000 AS loan_amount,
  CAST(l_suppkey AS VARCHAR) AS lender_name, CAST(l_partkey AS VARCHAR) AS originator_name
FROM current_loans"""

_MAPPING = """
links AS (
  SELECT c_custkey AS property_id, CAST(c_custkey AS VARCHAR) AS tax_assessor_id, c_name AS identifier,
    CAST(10000 + c_custkey % 500 AS VARCHAR) AS zip, 'Y' AS active_flag,
    c_name || ' ' || CAST(10000 + c_custkey % 500 AS VARCHAR) AS derived_property_id
  FROM customer WHERE c_acctbal > 0)"""

ORACLE["active_mapping"] = f"{_with(_MAPPING)} SELECT * FROM links"

ORACLE["enrich_properties"] = f"""
{_with(_MAPPING)}
SELECT property_id, derived_property_id, tax_assessor_id, c_mktsegment, c_acctbal
FROM links JOIN customer ON c_custkey = property_id"""

ORACLE["enrich_loans"] = f"""
{_with(_LOANS, _MAPPING)}
SELECT property_id, l_orderkey AS loan_property, l_linenumber AS loan_zip,
  CAST(loan_origination_date AS INTEGER) AS loan_origination_date, l_returnflag AS loan_maturity_date,
  l_quantity * 1000000 AS loan_amount, CAST(l_suppkey AS VARCHAR) AS lender_name,
  derived_property_id, tax_assessor_id
FROM current_loans JOIN links ON property_id = l_partkey"""

ORACLE["enrich_transactions"] = f"""
{_with(_TXN, _MAPPING)}
SELECT recorder_id, tax_assessor_id, strftime(document_recorded_date, {_DAY}) AS document_recorded_date,
  CAST(document_amount AS DOUBLE) AS document_amount, derived_property_id
FROM txn JOIN links USING (tax_assessor_id)"""

ORACLE["clean_parcels"] = f"""
SELECT CAST(l_partkey AS VARCHAR) AS tax_assessor_id, 'P-' || l_partkey AS identifier,
  CAST(10000 + l_partkey % 500 AS VARCHAR) AS zip, CAST(l_partkey % 60 AS VARCHAR) AS fips_code,
  CAST(l_partkey % 900 AS VARCHAR) AS census_tract, CAST(l_partkey % 9 AS VARCHAR) AS census_block_group,
  CASE WHEN l_partkey % 6 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN CAST(l_partkey % 1000 AS DOUBLE)
       ELSE CAST(1000 + l_partkey % 1000 AS DOUBLE) END AS room_count,
  1900 + l_partkey % 100 AS year_built,
  CASE WHEN l_partkey % 7 <> 0 THEN strftime(l_shipdate, {_DAY}) END AS last_sale_date,
  'P-' || l_partkey || ' ' || (10000 + l_partkey % 500) AS derived_property_id,
  (l_partkey % 60) || '' || (l_partkey % 900) || (l_partkey % 9) AS fips_tract_block_group
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) = 1"""

ORACLE["rollup_parcels"] = """
WITH p AS (
  SELECT *, CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(p_retailprice / 2 AS DECIMAL(18,2)) AS half FROM part),
modes AS (
  SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn
  FROM p GROUP BY p_brand, p_type),
firsts AS (
  SELECT p_brand, p_partkey, p_name FROM p
  QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) = 1)
SELECT p.p_brand, f.p_partkey, f.p_name, count(*) AS parcels, CAST(sum(price) AS DOUBLE) AS price_total,
  min(p_size) AS least_size, CAST(max(price) AS DOUBLE) AS greatest_price,
  CAST(sum(half) AS DOUBLE) / count(half) AS mean_price, m.p_type AS common_type
FROM p JOIN firsts f USING (p_brand) JOIN modes m ON m.p_brand = p.p_brand AND m.rn = 1
GROUP BY p.p_brand, f.p_partkey, f.p_name, m.p_type"""


def _window(kind: str) -> str:
    return f"""
{_with(_MAPPING)}
SELECT property_id, 'Market ' || CAST(user_id % 9 AS VARCHAR) AS market_name, event_type AS series,
  strftime(ts, {_TIME}) AS record_date, value AS record_values, derived_property_id, zip
FROM events JOIN links ON property_id = user_id
WHERE event_type = '{kind}'
  AND ts >= (SELECT max(ts) FROM events WHERE event_type = '{kind}') - INTERVAL 14 DAY"""


ORACLE["agg_rental"] = _window("view")
ORACLE["agg_occupancy"] = _window("purchase")

ORACLE["load_series"] = f"""
SELECT user_id AS property_id, 'Market ' || CAST(user_id % 9 AS VARCHAR) AS market_name, event_type AS series,
  strftime(ts, {_TIME}) AS record_date, value AS record_values
FROM events WHERE event_type IN ('view', 'purchase')"""

_AREAS = """
areas AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS census_tract, year(o_orderdate) || 'A' AS vintage,
    count(*) AS household_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_income
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""

ORACLE["demographics_by_tract"] = f"""
{_with(_AREAS)}
SELECT CAST(c_custkey AS VARCHAR) AS tax_assessor_id, census_tract, vintage, household_count
FROM customer JOIN areas ON census_tract = CAST(c_nationkey AS VARCHAR) WHERE vintage = '1997A'"""

ORACLE["agg_demographic"] = f"""
{_with(_AREAS)}
SELECT c_name || ' ' || CAST(10000 + c_custkey % 500 AS VARCHAR) AS derived_property_id,
  CAST(c_custkey AS VARCHAR) AS tax_assessor_id, CAST(10000 + c_custkey % 500 AS VARCHAR) AS zip, vintage,
  household_count, total_income
FROM customer JOIN areas ON census_tract = CAST(c_nationkey AS VARCHAR)
WHERE vintage = (SELECT max(vintage) FROM areas)"""

# ---- streaming ---------------------------------------------------------------

ORACLE["incremental_ingest"] = f"""
SELECT user_id, strftime(day, {_TIME}) AS ts, event_type, event_id FROM (
  SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id) = 1)"""


# ---- jobs ---------------------------------------------------------------------

_WINDOWS = """
windows(batch, first_day, last_day) AS (
  VALUES ('a', DATE '1992-01-01', DATE '1995-12-31'), ('b', DATE '1995-06-01', DATE '2009-12-31'))"""

ORACLE["job_raw_transactions"] = f"""
{_with(_TXN, _WINDOWS)}
SELECT batch, recorder_id, tax_assessor_id, strftime(document_recorded_date, {_DAY}) AS document_recorded_date,
  CAST(document_amount AS DOUBLE) AS document_amount,
  CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 4 ELSE 0 END AS grantor_count,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 3 ELSE 0 END AS grantee_count
FROM txn JOIN windows ON document_recorded_date BETWEEN first_day AND last_day"""

ORACLE["job_raw_grantors"] = f"""
{_with(_GRANTORS, _WINDOWS)}
SELECT batch, e.* FROM ({_exploded("grantor", "Seller", "r")}) e
JOIN orders ON recorder_id = CAST(o_orderkey AS VARCHAR)
JOIN windows ON CAST(o_orderdate AS DATE) BETWEEN first_day AND last_day"""

ORACLE["job_raw_mortgages"] = f"""
{_with(_WINDOWS)}
SELECT batch, CAST(o_orderkey AS VARCHAR) AS recorder_id, o_orderkey % 4 - (o_orderkey % 4 >= 2)::INT AS n
FROM orders JOIN windows ON CAST(o_orderdate AS DATE) BETWEEN first_day AND last_day
WHERE o_orderkey % 4 - (o_orderkey % 4 >= 2)::INT > 0"""

# keys go by the first window an id came in, then by the id
_JOB_KEYS = """
row_number() OVER (ORDER BY {first} > DATE '1995-12-31', {id})"""

ORACLE["job_fact"] = f"""
{_with(_TXN, _CLASS)}
SELECT {_JOB_KEYS.format(first="document_recorded_date", id="recorder_id")} AS transaction_key, recorder_id,
  CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AND tax_assessor_id <> '' THEN tax_assessor_id END
    AS tax_assessor_id,
  strftime(document_recorded_date, {_DAY}) AS transaction_date, CAST(document_amount AS DOUBLE) AS document_amount,
  transaction_category, is_sale, coalesce(inter_family_flag, '') <> '' AS is_inter_family,
  CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 4 ELSE 0 END AS grantor_count,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 3 ELSE 0 END AS grantee_count, property_state
FROM classified LEFT JOIN customer ON o_custkey = c_custkey"""

ORACLE["job_dim_property"] = f"""
{_with(_TXN)}
SELECT {_JOB_KEYS.format(first="first_day", id="tax_assessor_id")} AS property_key, tax_assessor_id,
  c_mktsegment AS property_use_code, CAST(1900 + c_custkey % 120 AS INTEGER) AS year_built,
  CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 23 <> 0 THEN CAST(500 + c_custkey % 9000 AS INTEGER) END AS building_sqft,
  true AS is_current
FROM (SELECT tax_assessor_id, min(document_recorded_date) AS first_day FROM txn WHERE tax_assessor_id <> '' GROUP BY 1)
JOIN customer ON tax_assessor_id = CAST(c_custkey AS VARCHAR)
WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')"""

_JOB_PARTIES = f"""
job_parties AS (
  SELECT recorder_id, 'grantor' AS party_role, grantor_name AS party_name_raw FROM ({_exploded("grantor", "Seller", "r")})
  WHERE grantor_name IS NOT NULL
  UNION ALL
  SELECT recorder_id, 'grantee', grantee_name FROM ({_exploded("grantee", "Buyer", "e")}) WHERE grantee_name IS NOT NULL)"""

ORACLE["job_dim_entity"] = f"""
{_with(_GRANTORS, _GRANTEES, _JOB_PARTIES)}
SELECT {_JOB_KEYS.format(first="first_day", id="canonical_entity_id")} AS entity_key, canonical_entity_id,
  true AS is_current
FROM (SELECT 'feed::' || upper(party_name_raw) AS canonical_entity_id, min(CAST(o_orderdate AS DATE)) AS first_day
      FROM job_parties JOIN orders ON recorder_id = CAST(o_orderkey AS VARCHAR) GROUP BY 1)"""

ORACLE["job_bridge_party"] = f"""
{_with(_GRANTORS, _GRANTEES, _JOB_PARTIES)}
SELECT *, 'feed::' || upper(party_name_raw) AS canonical_entity_id FROM job_parties"""

_JOB_ROWS = {
    "dim_property.property_key is unique": ORACLE["job_dim_property"],
    "dim_property (tax_assessor_id, valid_from) is unique": ORACLE["job_dim_property"],
    "dim_entity.entity_key is unique": ORACLE["job_dim_entity"],
    "fact_transaction.transaction_key is unique": ORACLE["job_fact"],
    "fact_transaction.recorder_id is unique": ORACLE["job_fact"],
}
ORACLE["job_validate"] = " UNION ALL ".join(
    f"SELECT '{check}' AS \"check\", count(*) AS passed, count(*) AS total FROM ({rows})"
    for check, rows in _JOB_ROWS.items()
)

ORACLE["job_backfill"] = """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, 1 AS tries FROM orders GROUP BY 1"""

ORACLE["file_properties"] = """
WITH months(m) AS (VALUES (1), (2), (3), (4))
SELECT 'p' || c_custkey AS property_id, '2024-0' || max(m) AS snapshot_month, 1000 + (c_custkey + max(m)) % 1000 AS units,
  '19' || (50 + max(m)) || '-05-01' AS completion_date, c_nationkey + CAST(0.5 AS DOUBLE) AS latitude
FROM customer, months WHERE c_custkey % m = 0 GROUP BY c_custkey, c_nationkey"""

ORACLE["file_loans"] = """
SELECT 'P' || (o_custkey % 700) AS property_name, CAST(10000 + o_custkey % 50 AS VARCHAR) AS zip,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS loan_origination_date,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 1000 AS DOUBLE) AS loan_amount,
  o_orderpriority AS lender_name, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS originator_name
FROM orders WHERE o_orderstatus = 'O'
QUALIFY row_number() OVER (PARTITION BY o_custkey % 700, o_custkey % 50, date_trunc('month', o_orderdate) ORDER BY o_orderkey) = 1"""

ORACLE["file_series"] = """
SELECT CAST(user_id AS VARCHAR) AS property_id, CASE event_type WHEN 'view' THEN 'Rent Actual' ELSE 'Occupancy Rate' END AS series,
  strftime(ts, '%Y-%m-%d') AS record_date, CASE WHEN event_id % 9 <> 0 THEN value END AS record_values
FROM events WHERE event_type IN ('view', 'purchase')"""

ORACLE["file_demographics"] = """
WITH counts AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1),
rows AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS geography_code, vintage, CAST(n + CASE vintage WHEN '2024A' THEN 1000 ELSE 0 END AS DOUBLE) AS household_count
  FROM nation JOIN counts ON c_nationkey = n_nationkey, (VALUES ('2023A'), ('2024A')) v(vintage))
SELECT *, (SELECT count(*) FROM rows) AS rows_added FROM rows"""

ORACLE["default_window"] = f"""
SELECT o_orderkey, strftime(o_orderdate, {_DAY}) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 1"""

ORACLE["file_sales"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS property_id, strftime(o_orderdate, {_DAY}) AS sale_date,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS sale_price, o_orderpriority AS buyer, o_orderstatus AS seller
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC,
  CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderpriority DESC, o_orderstatus DESC) = 1"""

ORACLE["file_mapping"] = """
SELECT CAST(c_custkey AS VARCHAR) AS property_id, CAST(c_custkey AS VARCHAR) AS tax_assessor_id,
  c_name || ' ' || (10000 + c_custkey % 500) AS derived_property_id
FROM customer WHERE c_acctbal > 0"""

ORACLE["file_audit"] = """
WITH loads(name, before_count, after_count) AS (
  SELECT 'sales', 0, count(DISTINCT o_custkey) FILTER (WHERE o_orderdate < TIMESTAMP '1998-06-01') FROM orders
  UNION ALL
  SELECT 'sales', count(DISTINCT o_custkey) FILTER (WHERE o_orderdate < TIMESTAMP '1998-06-01'),
    count(DISTINCT o_custkey) FROM orders
  UNION ALL
  SELECT 'mapping', 0, count(*) FROM customer WHERE c_acctbal > 0)
SELECT name AS table_name, 'raw' AS schema_name, '2025-01-01' AS insert_date, before_count, after_count,
  after_count - before_count AS new_rows FROM loads"""
