"""DuckDB statements giving the expected result of each query.

They follow the step-by-step set-difference formulation of the loads, not the
one-pass form of the operators.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"

DIM = """
pre AS (SELECT * FROM customer WHERE c_nationkey <> 0),
stg AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_nationkey IN (2, 4) THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_nationkey IN (3, 4) THEN c_mktsegment || '_OLD'
              WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_nationkey <> 1),
ins AS (SELECT * FROM pre WHERE NOT EXISTS (SELECT 1 FROM stg WHERE stg.c_custkey = pre.c_custkey)),
del AS (SELECT * FROM stg WHERE NOT EXISTS (SELECT 1 FROM pre WHERE stg.c_custkey = pre.c_custkey)),
upd AS (
  SELECT c_custkey, CAST(CASE WHEN sum(ch) = 3 THEN 2 ELSE sum(ch) END AS INTEGER) AS ch_type
  FROM (SELECT c_custkey, 2 AS ch FROM (SELECT c_custkey, c_mktsegment FROM pre EXCEPT SELECT c_custkey, c_mktsegment FROM stg)
        UNION ALL
        SELECT c_custkey, 1 AS ch FROM (SELECT c_custkey, c_name, c_acctbal FROM pre EXCEPT SELECT c_custkey, c_name, c_acctbal FROM stg))
  WHERE c_custkey NOT IN (SELECT c_custkey FROM ins)
  GROUP BY c_custkey),
ops AS (
  SELECT c_custkey, 'insert' AS op, CAST(NULL AS INTEGER) AS ch_type FROM ins
  UNION ALL SELECT c_custkey, 'delete', NULL FROM del
  UNION ALL SELECT c_custkey, 'update', ch_type FROM upd
  UNION ALL SELECT c_custkey, 'nochange', NULL FROM pre
    WHERE c_custkey NOT IN (SELECT c_custkey FROM ins) AND c_custkey NOT IN (SELECT c_custkey FROM upd)),
dim AS (
  SELECT c_custkey, c_nationkey, coalesce(c_mktsegment, 'NA_GDW') AS c_mktsegment, c_name, c_acctbal,
         TIMESTAMP '2000-01-01 00:00:00' AS date_active_from, TIMESTAMP '9999-12-31 23:59:59' AS date_active_to,
         'A' AS dw_active, c_custkey * 2 + 1 AS customer_key
  FROM stg
  UNION ALL
  SELECT c_custkey, c_nationkey, 'OLDEST', c_name, c_acctbal, TIMESTAMP '1999-01-01 00:00:00',
         TIMESTAMP '1999-12-31 00:00:00', 'I', c_custkey * 2 + 2
  FROM stg WHERE c_nationkey IN (3, 6)),
run AS (SELECT TIMESTAMP '2026-01-01 00:00:00' AS ts)"""


def _dim_columns(to: str = "date_active_to", flag: str = "dw_active", **other: str) -> str:
    cols = {c: c for c in ("c_custkey", "c_nationkey", "c_mktsegment", "c_name", "c_acctbal")}
    cols.update(other)
    picked = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    return (
        f"{picked}, strftime(date_active_from, {TS}) AS date_active_from, strftime({to}, {TS}) AS date_active_to, "
        f"{flag} AS dw_active, customer_key"
    )


EXPIRES = (
    "dw_active = 'A' AND (SELECT ts FROM run) >= date_active_from AND (SELECT ts FROM run) < date_active_to "
    "AND c_custkey IN (SELECT c_custkey FROM upd WHERE ch_type = 2)"
)
DELETES = "dw_active = 'A' AND c_custkey IN (SELECT c_custkey FROM del)"
YESTERDAY = "(SELECT ts FROM run) - INTERVAL 1 DAY"


def _closed(test: str) -> dict[str, str]:
    return {
        "to": f"CASE WHEN {test} THEN {YESTERDAY} ELSE date_active_to END",
        "flag": f"CASE WHEN {test} THEN 'I' ELSE dw_active END",
    }


def _overwritten(kind: str = "ch_type = 1", columns: tuple[str, ...] = ("c_name", "c_acctbal")) -> dict[str, str]:
    return {
        c: f"CASE WHEN c_custkey IN (SELECT c_custkey FROM upd WHERE {kind}) "
        f"THEN (SELECT p.{c} FROM pre p WHERE p.c_custkey = d.c_custkey) ELSE {c} END"
        for c in columns
    }


def _new_versions(source: str) -> str:
    return f"""
SELECT c_custkey, c_nationkey, coalesce(c_mktsegment, 'NA_GDW') AS c_mktsegment, c_name, c_acctbal,
       '2026-01-01 00:00:00' AS date_active_from, '9999-12-31 23:59:59' AS date_active_to, 'A' AS dw_active,
       (SELECT max(customer_key) FROM dim)
         + (row_number() OVER (PARTITION BY bucket ORDER BY c_custkey) - 1) * 4096 + bucket + 1 AS customer_key
FROM (SELECT *, CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 4096 AS bucket FROM ({source}))"""


INSERTED = "SELECT * FROM ins"
MOVED = "SELECT * FROM ins UNION ALL SELECT * FROM pre WHERE c_custkey IN (SELECT c_custkey FROM upd WHERE ch_type = 2)"

LINES = """
lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
    FROM lineitem)
  WHERE rn = 1)"""

FACT = (
    LINES
    + """,
fl AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_discount <> 0 THEN l_suppkey END AS l_suppkey, o_custkey, o_orderdate,
         CASE WHEN l_tax <> 0 THEN l_shipdate END AS l_shipdate, l_quantity, l_extendedprice, l_returnflag
  FROM lines JOIN orders ON l_orderkey = o_orderkey),
fpre AS (SELECT * FROM fl WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'),
fstg AS (
  SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
  FROM fl WHERE o_orderdate < TIMESTAMP '2000-06-01 00:00:00'),
fins AS (SELECT * FROM fpre p WHERE NOT EXISTS (
  SELECT 1 FROM fstg s WHERE s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber)),
fupd AS (
  SELECT l_orderkey, l_linenumber FROM (SELECT * FROM fpre EXCEPT SELECT * FROM fstg) a
  WHERE NOT EXISTS (SELECT 1 FROM fins i WHERE i.l_orderkey = a.l_orderkey AND i.l_linenumber = a.l_linenumber)),
fchg AS (SELECT p.* FROM fpre p JOIN fupd USING (l_orderkey, l_linenumber)),
parts AS (SELECT p_partkey, p_partkey + 1 AS part_key FROM part WHERE p_brand <> 'Brand#7'),
all_parts AS (SELECT p_partkey, p_partkey + 1 AS part_key FROM part),
supps AS (SELECT s_suppkey, s_suppkey + 1 AS supplier_key FROM supplier WHERE s_nationkey <> 9
          UNION ALL SELECT -99, -99),
dates AS (SELECT date_id, CAST(date_id AS INTEGER) AS date_key FROM (
  SELECT strftime(o_orderdate, '%Y%m%d') AS date_id FROM orders
  UNION SELECT strftime(l_shipdate, '%Y%m%d') FROM lineitem
  UNION SELECT '0')),
cur AS (SELECT c_custkey, customer_key FROM dim WHERE dw_active = 'A')"""
)


def _resolved(source: str, parts: str = "parts") -> str:
    return f"""
SELECT a.*, part_key, supplier_key, customer_key, o.date_key AS order_date_key, h.date_key AS ship_date_key
FROM ({source}) a
LEFT JOIN {parts} ON coalesce(l_partkey, -99) = p_partkey
LEFT JOIN supps ON coalesce(l_suppkey, -99) = s_suppkey
LEFT JOIN cur ON coalesce(o_custkey, -99) = c_custkey
LEFT JOIN dates o ON coalesce(strftime(o_orderdate, '%Y%m%d'), '0') = o.date_id
LEFT JOIN dates h ON coalesce(strftime(l_shipdate, '%Y%m%d'), '0') = h.date_id"""


MISSING = (
    "(part_key IS NULL OR supplier_key IS NULL OR customer_key IS NULL OR order_date_key IS NULL "
    "OR ship_date_key IS NULL)"
)
FACT_COLS = f"""l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, strftime(o_orderdate, {TS}) AS o_orderdate,
  strftime(l_shipdate, {TS}) AS l_shipdate, l_quantity, l_extendedprice, l_returnflag"""
KEY_COLS = "part_key, supplier_key, customer_key, order_date_key, ship_date_key"
LOADED = f"SELECT {FACT_COLS}, {KEY_COLS}"


def _versions(start: str) -> str:
    return f"'{start}' AS date_active_from, '9999-12-31 11:59:59' AS date_active_to, 1 AS dw_current"


OLD_FACT = f"SELECT *, 1 AS dw_current FROM ({_resolved('SELECT * FROM fstg')}) WHERE NOT {MISSING}"
EXPIRED_FACT = f"""
{LOADED}, '2000-01-01 00:00:00' AS date_active_from,
  CASE WHEN hit THEN '2025-12-31 00:00:00' ELSE '9999-12-31 11:59:59' END AS date_active_to,
  CASE WHEN hit THEN 0 ELSE 1 END AS dw_current
FROM (SELECT f.*, u.l_orderkey IS NOT NULL AS hit
      FROM ({OLD_FACT}) f LEFT JOIN fupd u ON f.l_orderkey = u.l_orderkey AND f.l_linenumber = u.l_linenumber)"""
ERRORS = f"""
{{head}} FROM ({{rows}}) WHERE {MISSING}"""
QUARANTINED = (
    f"SELECT 1 AS runid, {FACT_COLS}, {KEY_COLS}, 'ERROR' AS record_status, '2026-01-01 00:00:00' AS dw_creation_date"
)
BOTH = "SELECT * FROM fins UNION ALL SELECT * FROM fchg"


def _documents(kind: str, accounts: str) -> str:
    return (
        LINES
        + f""",
trx AS (
  SELECT o_orderkey AS transaction_id, 'DOC' || o_orderkey AS transaction_number, {kind} AS transaction_type,
         o_orderstatus AS status, o_custkey AS entity_id, o_custkey AS created_from_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 199 WHEN '2-HIGH' THEN 201 WHEN '3-MEDIUM' THEN 50 END AS custom_form_id,
         o_orderdate AS trandate, o_orderdate AS date_last_modified, o_custkey % 30 AS payment_terms_id
  FROM orders),
trx_lines AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS transaction_line_id, CAST(l_quantity AS BIGINT) - 1 AS account_id,
         l_partkey AS item_id, CASE WHEN l_linestatus = 'F' THEN 27 ELSE 28 END AS subsidiary_id,
         l_quantity AS item_count, l_extendedprice AS amount, l_shipdate AS date_last_modified
  FROM lines),
accounts AS (
  SELECT CAST(n_nationkey AS BIGINT) AS account_id, {accounts} AS name,
         CASE WHEN n_regionkey = 2 THEN '4000001' ELSE '5' || n_nationkey END AS accountnumber,
         CASE WHEN n_regionkey = 2 THEN 'Product Revenue : Revenue-Product' ELSE n_name END AS full_name
  FROM nation),
tax AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS transaction_line_id, l_suppkey AS tax_item_id,
         l_extendedprice * l_tax AS amount, l_tax AS amount_foreign
  FROM lines WHERE l_tax > 0)"""
    )


REVENUE = _documents(
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Sales Order' WHEN '2-HIGH' THEN 'Invoice' "
    "WHEN '3-MEDIUM' THEN 'Return Authorization' WHEN '4-NOT SPECIFIED' THEN 'Credit Memo' ELSE 'Journal' END",
    "CASE WHEN n_regionkey = 0 THEN 'AR-General' WHEN n_regionkey = 1 THEN 'Return Authorizations' "
    "WHEN n_regionkey IN (2, 3) THEN 'Revenue-Product' ELSE n_name END",
)
PURCHASE = _documents(
    "CASE o_orderstatus WHEN 'F' THEN 'Purchase Order' WHEN 'O' THEN 'Bill' ELSE 'Sales Order' END",
    "CASE WHEN n_regionkey = 0 THEN 'Purchase Orders' WHEN n_regionkey = 1 THEN 'AP-General' ELSE n_name END",
)


def _label(header: str, prefix: str, no_account: str | None, other: str | None) -> str:
    line = f"'{prefix}_LINE'" if other is None else f"CASE WHEN c.name = 'Revenue-Product' THEN '{prefix}_LINE' ELSE '{other}' END"
    missing = f"WHEN c.name IS NULL THEN '{no_account}' " if no_account else ""
    return (
        f"CASE WHEN c.name = '{header}' THEN '{prefix}_HDR' {missing}"
        f"WHEN d.transaction_line_id IS NULL THEN '{prefix}_TAX' ELSE {line} END"
    )


LABELS = {
    "Invoice": _label("AR-General", "INV", None, "INV_FRT"),
    "Return Authorization": _label("Return Authorizations", "RA", "RA_OTH", "RA_FRT"),
    "Credit Memo": _label("AR-General", "CN", "CN_OTH", "CN_OTH"),
    "Journal": _label("AR-General", "JN", "JN_OTH", "JN_OTH"),
}
REVENUE_FILTERS = {
    "Invoice": "EXISTS (SELECT 1 FROM trx g WHERE g.transaction_id = b.created_from_id AND g.transaction_type = 'Sales Order')",
    "Return Authorization": "EXISTS (SELECT 1 FROM trx g WHERE g.transaction_id = b.created_from_id "
    "AND g.transaction_type IN ('Sales Order', 'Invoice'))",
    "Credit Memo": "EXISTS (SELECT 1 FROM trx g WHERE g.transaction_id = b.created_from_id "
    "AND g.transaction_type IN ('Sales Order', 'Invoice'))",
    "Journal": "c.accountnumber = '4000001' AND c.full_name = 'Product Revenue : Revenue-Product'",
}
TAX_JOIN = """LEFT JOIN accounts c ON a.account_id = c.account_id
LEFT JOIN tax d ON a.transaction_id = d.transaction_id AND a.transaction_line_id = d.transaction_line_id"""


def _revenue_branch(kind: str) -> str:
    return f"""
SELECT b.transaction_number AS document_number, a.transaction_id, a.transaction_line_id, b.transaction_type,
       f.transaction_number AS ref_doc_number, f.custom_form_id AS ref_custom_form_id, b.entity_id AS customer_id,
       h.c_nationkey AS sales_rep_id, 'NATION_' || (o.o_custkey % 30) AS bill_country, o.o_orderpriority AS ship_city,
       a.account_id, a.item_id, a.item_count AS quantity, a.amount, d.amount AS tax_amount,
       strftime(b.trandate, {TS}) AS trandate, strftime(a.date_last_modified, {TS}) AS date_last_modified,
       {LABELS[kind]} AS line_type
FROM trx_lines a JOIN trx b ON a.transaction_id = b.transaction_id
{TAX_JOIN}
LEFT JOIN orders o ON a.transaction_id = o.o_orderkey
LEFT JOIN trx f ON b.created_from_id = f.transaction_id
LEFT JOIN customer h ON b.entity_id = h.c_custkey
WHERE a.subsidiary_id = 27 AND b.transaction_type = '{kind}' AND {REVENUE_FILTERS[kind]}
  AND a.date_last_modified >= TIMESTAMP '1996-01-01 00:00:00'"""


HIERARCHY = """
edges AS (
  SELECT a.c_custkey AS node_id, a.c_name AS full_name,
         CASE WHEN a.c_custkey > 0 THEN (a.c_custkey - 1) // 4 END AS parent_id
  FROM customer a),
ref AS (
  SELECT a.node_id, a.full_name, a.parent_id, b.full_name AS parent_full_name
  FROM edges a LEFT JOIN edges b ON a.parent_id = b.node_id)"""

WATERMARKS = """
wm AS (SELECT event_type AS fact_name, CAST(user_id AS VARCHAR) AS subsidiary_id, min(ts) AS ext_start_dt,
              max(ts) AS ext_end_dt
       FROM events GROUP BY ALL)"""


def _text_key(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _codes(name: str, table: str, column: str) -> str:
    return (
        f"{name}_list AS (SELECT DISTINCT {_text_key(column)} AS {name}_id, {column} AS {name} FROM {table} "
        f"UNION ALL SELECT -99, 'NA_GDW' UNION ALL SELECT 0, 'NA_ERR')"
    )


FACT_DIMS = """
d_nation AS (SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_nationkey + 1 AS BIGINT) AS key FROM nation UNION ALL SELECT -99, -99),
d_subs AS (SELECT CAST(n_nationkey + 10 AS BIGINT) AS id, CAST(n_nationkey + 1 AS BIGINT) AS key FROM nation UNION ALL SELECT -99, -99),
d_types AS (SELECT CAST(n_nationkey + 180 AS BIGINT) AS id, CAST(n_nationkey + 1 AS BIGINT) AS key FROM nation UNION ALL SELECT -99, -99),
d_cust AS (SELECT c_custkey AS id, customer_key AS key FROM cur UNION ALL SELECT -99, -99),
d_supp AS (SELECT s_suppkey AS id, supplier_key AS key FROM supps),
d_part AS (SELECT p_partkey AS id, part_key AS key FROM parts),
d_date AS (SELECT date_id AS id, date_key AS key FROM dates)"""


def _load(rows: str, lookups: dict[str, tuple[str, str]], more: str, extra_join: str = "", extra_key: str = "") -> str:
    """Keys of the lines in ``rows``; a lookup is key name -> (dimension, id expression)."""
    joins, keys = [], []
    for i, (name, (dim, expr)) in enumerate(lookups.items()):
        on = f"coalesce(strftime(CAST({expr} AS TIMESTAMP), '%Y%m%d'), '0')" if dim == "d_date" else f"coalesce({expr}, -99)"
        joins.append(f"LEFT JOIN {dim} j{i} ON {on} = j{i}.id")
        keys.append((f"j{i}.key", name))
    tests = [k for k, _ in keys] + ([extra_key.split(" AS ")[0]] if extra_key else [])
    shown = ", ".join(f"{k} AS {n}" for k, n in keys) + (f", {extra_key}" if extra_key else "")
    return f"""
SELECT a.transaction_id, a.transaction_line_id, {shown}, {more}, {" OR ".join(f"{t} IS NULL" for t in tests)} AS rejected
FROM ({rows}) a
{chr(10).join(joins)} {extra_join}"""


N, D = "d_nation", "d_date"
PO_LOOKUPS = {
    "vendor_key": ("d_cust", "vendor_id"), "requester_key": ("d_supp", "NULL"), "approver_level1_key": ("d_supp", "NULL"),
    "approver_level2_key": ("d_supp", "NULL"), "create_date_key": (D, "NULL"), "subsidiary_key": ("d_subs", "27"),
    "requested_receipt_date_key": (D, "NULL"), "actual_delivery_date_key": (D, "NULL"),
    "freight_estimate_method_key": (N, "NULL"), "currency_key": (N, "NULL"), "location_key": (N, "NULL"),
    "item_key": ("d_part", "item_id"), "terms_key": (N, "terms_id"), "tax_item_key": ("d_supp", "NULL"),
    "cost_center_key": (N, "NULL"), "class_key": (N, "NULL"), "carrier_key": (N, "NULL"),
}
VB_LOOKUPS = {
    "vendor_key": ("d_cust", "vendor_id"), "create_date_key": (D, "NULL"), "due_date_key": (D, "NULL"),
    "gl_post_date_key": (D, "NULL"), "vendor_bill_date_key": (D, "NULL"), "close_date_key": (D, "NULL"),
    "requester_key": ("d_supp", "NULL"), "approver_level1_key": ("d_supp", "NULL"), "approver_level2_key": ("d_supp", "NULL"),
    "subsidiary_key": ("d_subs", "27"), "location_key": (N, "NULL"), "item_key": ("d_part", "item_id"),
    "cost_center_key": (N, "NULL"), "currency_key": (N, "NULL"), "terms_key": (N, "payment_terms_id"),
    "tax_item_key": ("d_supp", "tax_item_id"), "class_key": (N, "NULL"),
}
VRA_LOOKUPS = {
    "vendor_key": ("d_cust", "o_custkey"), "requester_key": ("d_supp", "l_suppkey"), "create_date_key": (D, "o_orderdate"),
    "receive_date_key": (D, "l_shipdate"), "close_date_key": (D, "NULL"), "subsidiary_key": ("d_subs", "NULL"),
    "location_key": (N, "NULL"), "cost_center_key": (N, "NULL"), "item_key": ("d_part", "l_partkey"),
    "tax_item_key": ("d_supp", "NULL"), "currency_key": (N, "NULL"), "class_key": (N, "NULL"),
}
REVENUE_LOOKUPS = {
    "terms_key": (N, "terms_id"), "territory_key": (N, "sales_rep_id"), "currency_key": (N, "NULL"),
    "transaction_date_key": (D, "trandate"), "account_key": (N, "account_id"), "item_key": ("d_part", "item_id"),
    "tax_item_key": ("d_supp", "NULL"), "subsidiary_key": ("d_subs", "27"), "location_key": (N, "NULL"),
    "class_key": (N, "NULL"), "customer_key": ("d_cust", "customer_id"), "ref_doc_type_key": ("d_types", "ref_custom_form_id"),
    "document_type_key": ("d_types", "custom_form_id"), "accounting_period_key": (N, "NULL"),
}
NO_FACT_LINES = FACT.replace(LINES + ",", "", 1)

ORACLE: dict[str, str] = {
    "incremental_extract": f"""
SELECT event_id, strftime(ts, {TS}) AS ts, user_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_type = 'purchase'""",
    "modified_line_or_header": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, strftime(l_shipdate, {TS}) AS l_shipdate,
       strftime(o_orderdate, {TS}) AS o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate >= TIMESTAMP '2001-06-01 00:00:00' OR o_orderdate >= TIMESTAMP '2001-06-01 00:00:00'""",
    "stamp_run_id": "SELECT 1 AS runid, * FROM customer",
    "clean_line_breaks_text": """
SELECT doc_id, replace(replace(text || chr(13) || chr(10) || 'end', chr(10), ' '), chr(13), ' ') AS text FROM documents""",
    "escape_line_breaks_text": """
SELECT conv_id, turn, replace(replace(text || chr(13) || chr(10) || 'end', chr(10), '\\' || chr(10)), chr(13), '\\' || chr(13)) AS text
FROM conversations""",
    "active_only": """
SELECT * FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN 'Yes' ELSE 'No' END AS is_inactive FROM customer)
WHERE is_inactive = 'No'""",
    "effective_now": f"""
WITH {DIM} SELECT customer_key, c_custkey, c_mktsegment FROM dim, run
WHERE dw_active = 'A' AND run.ts >= date_active_from AND run.ts < date_active_to""",
    "latest_per_key": f"""
WITH {LINES} SELECT * REPLACE (strftime(l_shipdate, {TS}) AS l_shipdate) FROM lines""",
    "document_union": """
SELECT 'Invoice' AS document_type, o_orderkey AS transaction_id, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'Return Authorization', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'Credit Memo', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
    "minus_distinct": f"""
WITH {DIM} SELECT c_mktsegment, c_nationkey FROM pre EXCEPT SELECT c_mktsegment, c_nationkey FROM stg""",
    "code_decode_values": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' END AS no_default,
       CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE 'Other' END AS with_default,
       CASE WHEN s = 'F' THEN 'Final' WHEN s IS NULL THEN 'Missing' ELSE 'Other' END AS null_matched,
       CASE WHEN s IS NULL THEN 'NO' ELSE 'YES' END AS present
FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS s FROM orders)""",
    "fill_unknown_values": """
SELECT c_custkey, CASE WHEN length(s) > 0 THEN s ELSE 'NA_GDW' END AS segment, coalesce(b, -99) AS balance,
       coalesce(s, 'NA_GDW') AS null_only, CASE WHEN length(s) = 0 THEN 'NA_GDW' ELSE s END AS empty_only,
       CASE WHEN length(s) > 0 THEN s ELSE 'NA_GDW' END AS both
FROM (SELECT c_custkey, CASE WHEN c_nationkey = 5 THEN '' WHEN c_nationkey <> 6 THEN c_mktsegment END AS s,
             CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b FROM customer)""",
    "line_type_labels": f"""
WITH {REVENUE}
SELECT a.transaction_id, a.transaction_line_id,
       CASE b.transaction_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in LABELS.items())} END AS line_type
FROM trx_lines a JOIN trx b ON a.transaction_id = b.transaction_id
{TAX_JOIN}""",
    "text_timestamps": f"""
SELECT event_id, strftime(ts, {TS}) AS ts_text, date_trunc('second', ts) >= TIMESTAMP '2024-01-15 00:00:00' AS is_new
FROM events""",
    "account_label_text": """
SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_suppkey || ' ' || s_name ELSE s_name END AS account_label FROM supplier""",
    "parent_lookup": f"WITH {HIERARCHY} SELECT * FROM ref",
    "role_playing_dates": f"""
WITH {DIM}, {FACT} SELECT l_orderkey, l_linenumber, order_date_key, ship_date_key FROM ({_resolved("SELECT * FROM fl")})""",
    "date_key_lookup": f"""
WITH {DIM}, {FACT}
SELECT day, date_key, count(*) AS n_lines
FROM (SELECT coalesce(strftime(CASE WHEN l_tax <> 0 THEN l_shipdate END, '%Y%m%d'), '0') AS day FROM lineitem)
LEFT JOIN dates ON day = date_id GROUP BY ALL""",
    "created_from_semi": f"""
WITH {REVENUE}
SELECT transaction_id, transaction_number, created_from_id FROM trx b
WHERE transaction_type = 'Credit Memo' AND {REVENUE_FILTERS["Credit Memo"]}""",
    "items_without_tax": """
SELECT p_partkey, p_name, p_brand FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_tax = 0.08)""",
    "period_rollup": """
WITH d AS (SELECT DISTINCT year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m FROM orders)
SELECT CAST(y * 1000 + q * 100 + m AS INTEGER) AS accounting_period_id, CAST(y * 1000 + q * 100 AS INTEGER) AS parent_id,
       'M' || m || ' ' || y AS name, 'No' AS quarter, 'No' AS year_0, 'Q' || q || ' ' || y AS quarter_name,
       'FY ' || y AS year_name
FROM d""",
    "junk_dimension": f"""
WITH {_codes("status", "orders", "o_orderstatus")}, {_codes("priority", "orders", "o_orderpriority")},
{_codes("return_flag", "lineitem", "l_returnflag")}, {_codes("line_status", "lineitem", "l_linestatus")},
{_codes("segment", "customer", "c_mktsegment")}
SELECT * FROM status_list, priority_list, return_flag_list, line_status_list, segment_list""",
    "snapshot_diff": f"WITH {DIM} SELECT * FROM ops",
    "classify_changes": f"WITH {DIM} SELECT * FROM upd",
    "delta_counts": f"""
WITH {DIM}
SELECT (SELECT count(*) FROM pre) AS ingested, (SELECT count(*) FROM ins) AS inserted, (SELECT count(*) FROM upd) AS updated,
       (SELECT count(*) FROM del) AS deleted, (SELECT count(*) FROM ops WHERE op = 'nochange') AS unchanged""",
    "stage_refresh": f"""
WITH {DIM}
SELECT * FROM ins
UNION ALL SELECT * FROM pre WHERE c_custkey IN (SELECT c_custkey FROM upd)
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM stg
  WHERE c_custkey NOT IN (SELECT c_custkey FROM upd) AND c_custkey NOT IN (SELECT c_custkey FROM del)""",
    "scd_insert": f"WITH {DIM} {_new_versions(INSERTED)}",
    "scd2_expire": f"WITH {DIM} SELECT {_dim_columns(**_closed(EXPIRES))} FROM dim d",
    "scd1_update": f"WITH {DIM} SELECT {_dim_columns(**_overwritten())} FROM dim d",
    "soft_delete": f"WITH {DIM} SELECT {_dim_columns(**_closed(DELETES))} FROM dim d",
    "soft_delete_all_versions": f"""
WITH {DIM}
SELECT {_dim_columns(**_closed("c_nationkey IN (0, 6)"))} FROM dim d""",
    "scd2_merge": f"""
WITH {DIM}
SELECT {_dim_columns(**_closed(f"({EXPIRES} OR {DELETES})"), **_overwritten())} FROM dim d
UNION ALL {_new_versions(MOVED)}""",
    "scd1_only": f"""
WITH {DIM},
upd1 AS (SELECT c_custkey FROM (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM pre
         EXCEPT SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM stg) WHERE c_custkey NOT IN (SELECT c_custkey FROM ins))
SELECT {_dim_columns(
    **_closed(DELETES),
    **{c: e.replace("FROM upd WHERE", "FROM upd1 WHERE") for c, e in
       _overwritten("true", ("c_name", "c_acctbal", "c_mktsegment")).items()})} FROM dim d
UNION ALL {_new_versions(INSERTED)}""",
    "seed_default_members": """
SELECT s_suppkey, s_name, s_suppkey + 1 AS supplier_key FROM supplier
UNION ALL SELECT -99, 'NA_GDW', -99
UNION ALL SELECT 0, 'NA_ERR', 0 WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = 0)""",
    "fact_diff": f"""
WITH {DIM}, {FACT}
SELECT l_orderkey, l_linenumber, 'insert' AS op FROM fins
UNION ALL SELECT l_orderkey, l_linenumber, 'update' FROM fupd
UNION ALL (SELECT l_orderkey, l_linenumber, 'nochange' FROM fpre
  EXCEPT (SELECT l_orderkey, l_linenumber, 'nochange' FROM fins UNION ALL SELECT l_orderkey, l_linenumber, 'nochange' FROM fupd))""",
    "diff_balance": f"""
WITH {DIM}, {FACT}, n AS (
  SELECT (SELECT count(*) FROM fpre) AS ingested, (SELECT count(*) FROM fins) AS inserted, (SELECT count(*) FROM fupd) AS updated,
         (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM fpre EXCEPT
           (SELECT l_orderkey, l_linenumber FROM fins UNION ALL SELECT l_orderkey, l_linenumber FROM fupd))) AS unchanged)
SELECT *, ingested = inserted + updated + unchanged AS balanced FROM n""",
    "fact_stage_refresh": f"""
WITH {DIM}, {FACT}
SELECT {FACT_COLS} FROM (
  SELECT s.* FROM fstg s WHERE NOT EXISTS (
    SELECT 1 FROM fupd u WHERE u.l_orderkey = s.l_orderkey AND u.l_linenumber = s.l_linenumber)
  UNION ALL SELECT * FROM fins UNION ALL SELECT * FROM fchg)""",
    "resolve_keys": f"""
WITH {DIM}, {FACT}
SELECT l_orderkey, l_linenumber, {KEY_COLS}, {MISSING} AS rejected FROM ({_resolved("SELECT * FROM fl")})""",
    "fact_insert": f"""
WITH {DIM}, {FACT}
{LOADED}, {_versions("2026-01-01 00:00:00")} FROM ({_resolved("SELECT * FROM fins")}) WHERE NOT {MISSING}""",
    "fact_quarantine": f"""
WITH {DIM}, {FACT} {ERRORS.format(head=QUARANTINED, rows=_resolved("SELECT * FROM fins"))}""",
    "fact_update_quarantine": f"""
WITH {DIM}, {FACT} {ERRORS.format(head=QUARANTINED, rows=_resolved("SELECT * FROM fchg"))}""",
    "fact_expire": f"WITH {DIM}, {FACT} {EXPIRED_FACT}",
    "fact_version_merge": f"""
WITH {DIM}, {FACT} {EXPIRED_FACT}
UNION ALL
{LOADED}, {_versions("2026-01-01 00:00:00")} FROM ({_resolved(BOTH)}) WHERE NOT {MISSING}""",
    "reprocess_errors": f"""
WITH {DIM}, {FACT},
errors AS (SELECT * EXCLUDE ({KEY_COLS}) FROM ({_resolved(BOTH)}) WHERE {MISSING})
{LOADED}, {_versions("2026-01-02 00:00:00")} FROM ({_resolved("SELECT * FROM errors", "all_parts")}) WHERE NOT {MISSING}""",
    "reprocess_error_marks": f"""
WITH {DIM}, {FACT},
errors AS (SELECT * EXCLUDE ({KEY_COLS}) FROM ({_resolved(BOTH)}) WHERE {MISSING})
SELECT 1 AS runid, l_orderkey, l_linenumber, {KEY_COLS}, CASE WHEN {MISSING} THEN 'ERROR' ELSE 'RESOLVED' END AS record_status
FROM ({_resolved("SELECT * FROM errors", "all_parts")})""",
    "revenue_fact": f"WITH {REVENUE} " + " UNION ALL ".join(_revenue_branch(k) for k in REVENUE_FILTERS),
    "po_fact": f"""
WITH {PURCHASE}
SELECT b.transaction_number AS po_number, a.transaction_id, a.transaction_line_id, f.transaction_number AS ref_trx_number,
       f.transaction_type AS ref_trx_type, b.entity_id AS vendor_id,
       'House' || chr(10) || b.entity_id AS bill_address_line_1, b.status AS po_status,
       CASE b.custom_form_id WHEN 199 THEN 'INTL Inventory Purchase Order' WHEN 201 THEN 'INTL Drop Ship Purchase Order'
            WHEN 202 THEN 'INTL Non-Inventory Purchase Order' END AS po_type,
       a.item_id, a.item_count, a.amount, d.amount_foreign AS tax_amount,
       strftime(b.date_last_modified, {TS}) AS date_last_modified,
       {_label("Purchase Orders", "PO", None, None)} AS line_type
FROM trx_lines a JOIN trx b ON a.transaction_id = b.transaction_id
{TAX_JOIN}
LEFT JOIN trx f ON b.created_from_id = f.transaction_id
WHERE b.transaction_type = 'Purchase Order' AND a.subsidiary_id = 27
  AND (a.date_last_modified >= TIMESTAMP '1998-01-01 00:00:00' OR b.date_last_modified >= TIMESTAMP '1998-01-01 00:00:00')""",
    "vendor_bill_fact": f"""
WITH {PURCHASE},
exc AS (SELECT user_id, count(*) AS n, arg_max(props, {{'ts': ts, 'props': props}}) AS message
        FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT b.transaction_number AS vb_number, a.transaction_id, a.transaction_line_id, f.transaction_number AS ref_trx_number,
       b.entity_id AS vendor_id, CAST(h.n_nationkey AS BIGINT) AS payment_terms_id, c.full_name AS account_name,
       c.accountnumber AS account_number, 'House ' || b.entity_id AS vendor_address_line_1,
       coalesce('Country ' || g.n_nationkey, 'NATION_' || (b.entity_id % 30)) AS vendor_country, d.tax_item_id,
       d.amount AS tax_amount,
       CASE b.custom_form_id WHEN 199 THEN 'Drop ship bill' WHEN 50 THEN 'Standard bill' ELSE 'NA_GDW' END AS vb_type,
       CASE WHEN i.user_id IS NULL THEN 'NO' ELSE 'YES' END AS match_exception, i.message AS exception_message,
       i.n AS exception_count, strftime(a.date_last_modified, {TS}) AS date_last_modified,
       {_label("AP-General", "VB", None, None)} AS line_type
FROM trx_lines a JOIN trx b ON a.transaction_id = b.transaction_id
{TAX_JOIN}
LEFT JOIN trx f ON b.created_from_id = f.transaction_id
LEFT JOIN nation g ON g.n_name = 'NATION_' || (b.entity_id % 30)
LEFT JOIN nation h ON b.payment_terms_id = h.n_nationkey
LEFT JOIN exc i ON b.transaction_id = i.user_id
WHERE b.transaction_type = 'Bill' AND b.date_last_modified >= TIMESTAMP '1998-01-01 00:00:00' AND a.subsidiary_id = 27""",
    "hierarchy_depth": f"""
WITH RECURSIVE {HIERARCHY},
base AS (SELECT *, 0 AS depth FROM ref WHERE parent_id IS NULL
         UNION ALL SELECT b.*, a.depth + 1 FROM base a JOIN ref b ON a.node_id = b.parent_id)
SELECT node_id, full_name, parent_id, parent_full_name, CAST(nullif(depth, 0) AS INTEGER) AS level FROM base""",
    "hierarchy_closure": f"""
WITH RECURSIVE {HIERARCHY},
base AS (SELECT *, 0 AS depth FROM ref WHERE parent_id IS NULL
         UNION ALL SELECT b.*, a.depth + 1 FROM base a JOIN ref b ON a.node_id = b.parent_id),
final AS (SELECT node_id, full_name, parent_id, parent_full_name, 1 AS level, depth FROM base WHERE depth > 0
          UNION ALL
          SELECT b.node_id, b.full_name, a.parent_id, a.parent_full_name, b.level + 1, b.depth
          FROM final b JOIN base a ON a.node_id = b.parent_id WHERE a.depth > 0)
SELECT node_id, full_name, parent_id, parent_full_name, CAST(level AS INTEGER) AS level,
       CAST(CASE WHEN depth = 1 THEN 0 ELSE depth END AS INTEGER) AS q_level FROM final
UNION ALL SELECT node_id, full_name, node_id, full_name, 0, NULL FROM base""",
    "watermark_read": f"""
WITH {WATERMARKS} SELECT fact_name, subsidiary_id, strftime(ext_end_dt, {TS}) AS watermark FROM wm WHERE fact_name = 'purchase'""",
    "watermark_advance": f"""
WITH {WATERMARKS}
SELECT fact_name, subsidiary_id,
       CASE WHEN fact_name = 'purchase' AND subsidiary_id = '8' THEN '2024-01-15 00:00:00' ELSE strftime(ext_start_dt, {TS}) END AS ext_start_dt,
       CASE WHEN fact_name = 'purchase' AND subsidiary_id = '8' THEN '2024-02-01 00:00:00' ELSE strftime(ext_end_dt, {TS}) END AS ext_end_dt
FROM wm""",
    "job_status": """
SELECT event_id AS job_id, CAST(user_id AS INTEGER) AS runid, event_type AS entity,
       CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Success' END AS job_status FROM events""",
    "failed_jobs": """
SELECT CAST(user_id AS INTEGER) AS runid, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY ALL""",
    "next_run": "SELECT CAST(max(user_id) + 1 AS INTEGER) AS next_run_id FROM events",
    "message_log": f"""
WITH {DIM},
n AS (SELECT 'ingested' AS stage, count(*) AS n FROM pre UNION ALL SELECT 'inserted', count(*) FROM ins
      UNION ALL SELECT 'updated', count(*) FROM upd UNION ALL SELECT 'deleted', count(*) FROM del
      UNION ALL SELECT 'unchanged', count(*) FROM ops WHERE op = 'nochange')
SELECT 2 AS runid, 'no of records ' || stage || ' --> ' || n AS message_desc, 'customer' AS target_table,
       stage AS message_stage, 'Info' AS message_type, '2026-01-01 00:00:00' AS message_timestamp, '27' AS subsidiary_id
FROM n""",
}
ORACLE["resolve_keys_shuffled"] = ORACLE["resolve_keys"]
ORACLE["resolve_keys_stacked"] = ORACLE["resolve_keys"]
ORACLE["fact_stage_refresh_full"] = ORACLE["fact_stage_refresh"]
ORACLE["po_fact_load"] = (
    f"WITH {PURCHASE}, {DIM}, {NO_FACT_LINES}, {FACT_DIMS}, po AS ("
    + ORACLE["po_fact"].replace(f"WITH {PURCHASE}", "")
    + ")"
    + _load(
        "SELECT po.*, b.payment_terms_id AS terms_id FROM po JOIN trx b USING (transaction_id) WHERE line_type = 'PO_LINE'",
        PO_LOOKUPS, "item_count AS quantity, po_status AS status",
    )
)
ORACLE["vendor_bill_fact_load"] = (
    f"WITH {PURCHASE}, {DIM}, {NO_FACT_LINES}, {FACT_DIMS}, vb AS ("
    + ORACLE["vendor_bill_fact"].replace(f"WITH {PURCHASE},", "WITH ")
    + ")"
    + _load(
        "SELECT vb.*, l.item_id FROM vb JOIN trx_lines l USING (transaction_id, transaction_line_id) WHERE line_type = 'VB_LINE'",
        VB_LOOKUPS, "-99 AS account_key, ref_trx_number AS source_transaction_number",
    )
)
ORACLE["vendor_return_fact_load"] = f"WITH {DIM}, {FACT}, {FACT_DIMS}" + _load(
    "SELECT *, l_orderkey AS transaction_id, l_linenumber AS transaction_line_id FROM fl WHERE l_returnflag = 'R'",
    VRA_LOOKUPS,
    "CASE WHEN l_suppkey IS NULL THEN 'NA_GDW' ELSE 'RET' || l_orderkey END AS vra_number, l_quantity AS quantity",
)
ORACLE["revenue_fact_load"] = (
    f"WITH {REVENUE}, {DIM}, {NO_FACT_LINES}, {FACT_DIMS}, "
    + "d_status AS (SELECT DISTINCT status, transaction_type AS document_type, "
    + _text_key("status || '|' || transaction_type") + " AS key FROM trx WHERE transaction_type <> 'Journal'), rev AS ("
    + " UNION ALL ".join(_revenue_branch(k) for k in REVENUE_FILTERS)
    + ")"
    + _load(
        "SELECT rev.* REPLACE (b.trandate AS trandate), b.payment_terms_id AS terms_id, b.custom_form_id, b.status FROM rev "
        "JOIN trx b USING (transaction_id) WHERE line_type IN ('INV_LINE', 'RA_LINE', 'CN_LINE', 'JN_LINE')",
        REVENUE_LOOKUPS, "quantity",
        "LEFT JOIN d_status s ON a.status = s.status AND a.transaction_type = s.document_type",
        "s.key AS document_status_key",
    )
)
ORACLE["items_extract"] = """
WITH accounts AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id,
         CASE WHEN n_nationkey > 4 THEN n_nationkey || ' ' || n_name ELSE n_name END AS label FROM nation),
items AS (
  SELECT p_partkey AS item_id, p_name || chr(13) || chr(10) || p_partkey AS name, CAST(p_size AS BIGINT) AS asset_account_id,
         CASE WHEN p_type = 'ECONOMY' THEN 'Yes' ELSE 'No' END AS isinactive,
         CAST(p_size - 20 AS BIGINT) AS expense_account_id, CAST(p_size % 40 AS BIGINT) AS class_id,
         CASE WHEN p_partkey > 0 THEN p_partkey // 3 END AS parent_id
  FROM part)
SELECT a.item_id, replace(replace(a.name, chr(10), ' '), chr(13), ' ') AS name, a.isinactive, a.asset_account_id,
       a.expense_account_id, a.class_id, a.parent_id, e.label AS asset_account_number, k.label AS expense_account_number,
       i.n_name AS line_of_business, o.name AS parent_name
FROM items a LEFT JOIN accounts e ON a.asset_account_id = e.id LEFT JOIN accounts k ON a.expense_account_id = k.id
LEFT JOIN nation i ON a.class_id = i.n_nationkey LEFT JOIN items o ON a.parent_id = o.item_id
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = a.item_id AND l_tax = 0.08) AND a.isinactive = 'No'"""
ORACLE["employees_extract"] = """
WITH people AS (
  SELECT c_custkey AS employee_id, c_name || chr(10) AS full_name, CASE WHEN c_acctbal < 0 THEN 'Yes' ELSE 'No' END AS isinactive,
         CAST(c_nationkey + 2 AS BIGINT) AS subsidiary_id, CASE WHEN c_custkey > 0 THEN c_custkey // 5 END AS supervisor_id,
         CASE WHEN c_custkey > 9 THEN c_custkey // 7 END AS approver_id
  FROM customer)
SELECT a.employee_id, replace(a.full_name, chr(10), ' ') AS full_name, a.isinactive, a.subsidiary_id, a.supervisor_id,
       a.approver_id, e.n_name AS subsidiary, b.full_name AS supervisor_name, c.full_name AS approver_name
FROM people a LEFT JOIN people b ON a.supervisor_id = b.employee_id LEFT JOIN people c ON a.approver_id = c.employee_id
JOIN nation e ON a.subsidiary_id = e.n_nationkey
WHERE a.isinactive = 'No'"""
ORACLE["customers_extract"] = """
SELECT a.c_custkey AS customer_id, a.c_name AS name, 'No' AS isinactive,
       CASE WHEN a.c_acctbal < 0 THEN 'No' ELSE 'Yes' END AS is_person,
       CASE WHEN a.c_custkey > 0 THEN a.c_custkey // 4 END AS parent_id, 'Country ' || b.n_nationkey AS country,
       CASE WHEN a.c_acctbal < 0 THEN 'Company' ELSE 'Individual' END AS customer_type, j.c_name AS parent
FROM customer a LEFT JOIN nation b ON b.n_name = 'NATION_' || (a.c_nationkey + 3)
LEFT JOIN customer j ON (CASE WHEN a.c_custkey > 0 THEN a.c_custkey // 4 END) = j.c_custkey
WHERE a.c_mktsegment <> 'BUILDING'"""
ORACLE["dim_stage_refresh"] = ORACLE["stage_refresh"]

# Loads: the dimension of the first run has the keys that run assigned.
FIRST_DIM = DIM[: DIM.index("dim AS (")] + """dim AS (
  SELECT c_custkey, c_nationkey, coalesce(c_mktsegment, 'NA_GDW') AS c_mktsegment, c_name, c_acctbal,
         TIMESTAMP '2000-01-01 00:00:00' AS date_active_from, TIMESTAMP '9999-12-31 23:59:59' AS date_active_to,
         'A' AS dw_active,
         (row_number() OVER (PARTITION BY bucket ORDER BY c_custkey) - 1) * 4096 + bucket + 1 AS customer_key
  FROM (SELECT *, CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 4096 AS bucket FROM stg)),
run AS (SELECT TIMESTAMP '2026-01-01 00:00:00' AS ts)"""
ORACLE["dimension_two_runs"] = ORACLE["scd2_merge"].replace(DIM, FIRST_DIM)
ORACLE["dimension_buckets_two_runs"] = f"SELECT * EXCLUDE (customer_key) FROM ({ORACLE['dimension_two_runs']})"
ORACLE["hierarchy_closure_update"] = ORACLE["hierarchy_closure"]
ORACLE["latest_file"] = "SELECT * FROM customer"
ORACLE["fact_two_runs"] = ORACLE["fact_version_merge"]
ORACLE["reprocess_older_run"] = ORACLE["fact_two_runs"]
ORACLE["reprocess_older_dimension_run"] = ORACLE["dimension_two_runs"]
ORACLE["extract_file_round_trip"] = """
SELECT 1 AS runid, * REPLACE (nullif(c_mktsegment, 'BUILDING') AS c_mktsegment) FROM customer"""


def _two_run_counts(source: str, amount: str) -> str:
    return f"""SELECT count(*) AS ingested, CAST(0 AS BIGINT) AS inserted,
  count(CASE WHEN transaction_id % 10 = 0 AND {amount} IS NOT NULL THEN 1 END) AS updated, CAST(0 AS BIGINT) AS deleted,
  count(CASE WHEN transaction_id % 10 = 0 AND {amount} IS NOT NULL THEN NULL ELSE 1 END) AS unchanged FROM ({source})"""


ORACLE["po_fact_two_runs"] = _two_run_counts(ORACLE["po_fact"], "amount")
ORACLE["vendor_bill_fact_two_runs"] = _two_run_counts(
    f"""WITH {PURCHASE} SELECT a.transaction_id, a.amount FROM trx_lines a JOIN trx b ON a.transaction_id = b.transaction_id
WHERE b.transaction_type = 'Bill' AND a.subsidiary_id = 27 AND b.date_last_modified >= TIMESTAMP '1998-01-01 00:00:00'""",
    "amount",
)
ORACLE["vendor_return_fact_two_runs"] = f"WITH {DIM}, {FACT}" + _two_run_counts(
    "SELECT l_orderkey AS transaction_id, l_quantity AS item_count FROM fl", "item_count"
)
ORACLE["extract_text_round_trip"] = """
SELECT 1 AS runid, conv_id, turn, role, CASE conv_id % 6 WHEN 0 THEN text || chr(13) || chr(10) || '"q", \\' WHEN 1 THEN NULL
  WHEN 2 THEN '' WHEN 3 THEN '\\n,""' WHEN 4 THEN '""' ELSE text END AS text, CAST(NULL AS VARCHAR) AS _corrupt_record
FROM conversations UNION ALL SELECT 1, doc_id, -1, 'doc', text, NULL FROM documents"""
ORACLE["accounting_periods_extract"] = f"""
SELECT accounting_period_id, parent_id, name AS period_name, quarter, year_0, 'No' AS isinactive, 'from ' || name AS start_date,
  'to ' || name AS end_date, quarter_name, year_name, 'driver calendar' AS fiscal_calendar
FROM ({ORACLE["period_rollup"]}) WHERE accounting_period_id % 5 <> 0"""

ORACLE["ordered_extract"] = """
SELECT 1 AS runid, row_number() OVER (ORDER BY o_orderstatus DESC NULLS LAST, o_orderdate, o_orderkey) - 1 AS position,
  o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderkey FROM orders"""
ORACLE["foreign_extract"] = """
SELECT doc_id, coalesce(text, '') AS text, 'caf?!' AS note, '2026-01-02 03:04:05' AS loaded_at FROM documents"""

_TWO_RUNS = f"""
WITH {DIM}, {FACT},
errors AS (SELECT * EXCLUDE ({KEY_COLS}) FROM ({_resolved(BOTH)}) WHERE {MISSING}),
all_errors AS (
  SELECT *, 1 AS runid FROM errors
  UNION ALL
  SELECT * REPLACE (l_quantity + 1 AS l_quantity), 2 AS runid FROM errors WHERE l_linenumber % 2 = 0
),
newest AS (SELECT * EXCLUDE (runid) FROM all_errors QUALIFY runid = max(runid) OVER (PARTITION BY l_orderkey, l_linenumber))"""
ORACLE["reprocess_all_errors"] = f"""
{_TWO_RUNS}
{LOADED}, {_versions("2026-01-02 00:00:00")} FROM ({_resolved("SELECT * FROM newest", "all_parts")}) WHERE NOT {MISSING}"""
ORACLE["reprocess_all_marks"] = f"""
{_TWO_RUNS},
driven AS (SELECT l_orderkey, l_linenumber, {MISSING} AS missing FROM ({_resolved("SELECT * FROM newest", "all_parts")}))
SELECT CAST(runid AS INTEGER) AS runid, l_orderkey, l_linenumber, l_quantity,
  CASE WHEN runid = 1 AND l_linenumber % 2 = 0 THEN 'SUPERSEDED' WHEN missing THEN 'ERROR' ELSE 'RESOLVED' END AS record_status
FROM all_errors JOIN driven USING (l_orderkey, l_linenumber)"""
