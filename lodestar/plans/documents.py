"""Fact extracts: document lines with header, tax, address and source document.

``tables`` maps a source table name to its DataFrame: ``transactions``,
``transaction_lines``, ``accounts``, ``transaction_tax_detail``,
``transaction_address``, ``customers``, ``countries``, ``payment_terms`` and
``workflow_exceptions``. Ids, amounts and times keep their types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.functions.columns import clean_line_breaks, code_decode, presence_flag, ts_lit
from lodestar.functions.lines import line_type
from lodestar.functions.reserved import NA_TEXT
from lodestar.operators.joins import Side, join_sides

# Fixed values.
REVENUE_ACCOUNT_NUMBER = "4000001"
REVENUE_ACCOUNT_FULL_NAME = "Product Revenue : Revenue-Product"
REVENUE_SOURCES = {
    "Invoice": ("Sales Order",),
    "Return Authorization": ("Sales Order", "Invoice"),
    "Credit Memo": ("Sales Order", "Invoice"),
    "Journal": None,
}
PO_FORMS = {
    199: "INTL Inventory Purchase Order",
    201: "INTL Drop Ship Purchase Order",
    202: "INTL Non-Inventory Purchase Order",
}
ADDRESS_PARTS = ("address_line_1", "address_line_2", "address_line_3", "city", "country", "state", "zip")

# Header columns carried along: result name -> source name. Columns a source does
# not have are left out where ``absent`` names them.
HEADER = {
    "transaction_number": "transaction_number",
    "transaction_type": "transaction_type",
    "document_status": "status",
    "approval_status": "approval_status",
    "entity_id": "entity_id",
    "created_from_id": "created_from_id",
    "created_by_id": "created_by_id",
    "custom_form_id": "custom_form_id",
    "currency_id": "currency_id",
    "exchange_rate": "exchange_rate",
    "trandate": "trandate",
    "create_date": "create_date",
    "closed": "closed",
    "location_id": "location_id",
    "payment_terms_id": "payment_terms_id",
    "accounting_period_id": "accounting_period_id",
    "revenue_commitment_status": "revenue_commitment_status",
    "revenue_status": "revenue_status",
    "approver_level_one_id": "approver_level_one_id",
    "approver_level_two_id": "approver_level_two_id",
    "amount_unbilled": "amount_unbilled",
    "carrier_id": "carrier_lebel_id",
    "employee_custom_id": "employee_custom_id",
    "po_approver_id": "po_approver_id",
    "sales_rep": "sales_rep_id",
    "ext_ref_number": "external_ref_number",
    "payment_hold": "is_payment_hold",
    "vb_due_date": "due_date",
    "gl_post_date": "sales_effective_date",
    "vendor_bill_date": "supplier_create_date",
    "bill_requestor_id": "bill_requestor_id",
    "header_last_modified": "date_last_modified",
}


def _present(table: str, frame: DataFrame, wanted: Mapping[str, str], absent: Collection[str]) -> dict[str, str]:
    """``wanted`` (output name -> source column) without the columns that ``absent`` names; others must be there."""
    missing = sorted({c for c in wanted.values() if c not in frame.columns and c not in absent})
    if missing:
        raise ValueError(f"{table} lacks the columns {missing}; name those that the source does not have as absent")
    return {out: c for out, c in wanted.items() if c in frame.columns}


def _headers(tables: Mapping[str, DataFrame], types: Sequence[str], absent: Collection[str]) -> DataFrame:
    t = tables["transactions"].filter(F.col("transaction_type").isin(*types))
    kept = _present("transactions", t, HEADER, absent)
    return t.select("transaction_id", *[F.col(s).alias(a) for a, s in kept.items()])


def _source_document(tables: Mapping[str, DataFrame], **take: str) -> Side:
    return Side(tables["transactions"], [(F.col("created_from_id"), "transaction_id")], take)


def _address(tables: Mapping[str, DataFrame], kinds: Mapping[str, str], absent: Collection[str]) -> Side:
    a = tables["transaction_address"]
    wanted = {f"{out}_{part}": f"{kind}_{part}" for kind, out in kinds.items() for part in ADDRESS_PARTS}
    return Side(a, [(F.col("transaction_id"), "transaction_id")], _present("transaction_address", a, wanted, absent))


def _tax_and_account(tables: Mapping[str, DataFrame], **tax: str) -> list[Side]:
    return [
        Side(
            tables["accounts"],
            [(F.col("account_id"), "account_id")],
            {"account_name": "name", "account_number": "accountnumber", "account_full_name": "full_name"},
        ),
        Side(
            tables["transaction_tax_detail"],
            [(F.col("transaction_id"), "transaction_id"), (F.col("transaction_line_id"), "transaction_line_id")],
            {"tax_line_id": "transaction_line_id", **tax},
        ),
    ]


def _lines(tables: Mapping[str, DataFrame], subsidiary: Any, extra: Column | None = None) -> DataFrame:
    lines = tables["transaction_lines"].filter(F.col("subsidiary_id") == F.lit(subsidiary))
    return lines if extra is None else lines.filter(extra)


def _with_header(lines: DataFrame, headers: DataFrame, how: str = "inner") -> DataFrame:
    # Header columns win over line columns of the same name except on the key.
    shared = [c for c in lines.columns if c in headers.columns and c != "transaction_id"]
    return lines.drop(*shared).join(headers, "transaction_id", how)


def revenue_extract(
    tables: Mapping[str, DataFrame], subsidiary: Any, watermark: str | dt.datetime, absent: Collection[str] = ()
) -> DataFrame:
    """Order-to-cash lines of four document types in one pass.

    Each type has its own rule for the source document and its own line labels.
    The source document is joined once at header level and serves both its
    attributes and the existence test.
    """
    headers = join_sides(
        _headers(tables, list(REVENUE_SOURCES), absent),
        [
            _source_document(
                tables, ref_doc_number="transaction_number", ref_custom_form_id="custom_form_id",
                __source_type="transaction_type",
            ),
            _address(tables, {"bill": "bill", "ship": "ship"}, absent),
            Side(tables["customers"], [(F.col("entity_id"), "customer_id")], {"sales_rep_id": "sales_rep_id"}),
        ],
    )
    allowed = F.lit(False)
    for doc, sources in REVENUE_SOURCES.items():
        hit = F.col("transaction_type") == doc
        allowed = allowed | (hit if sources is None else hit & F.col("__source_type").isin(*sources))
    headers = headers.filter(allowed)
    lines = _lines(tables, subsidiary, F.col("date_last_modified") >= ts_lit(watermark))
    rows = join_sides(_with_header(lines, headers), _tax_and_account(tables, tax_amount="amount"))
    journal_ok = (F.col("account_number") == REVENUE_ACCOUNT_NUMBER) & (
        F.col("account_full_name") == REVENUE_ACCOUNT_FULL_NAME
    )
    rows = rows.filter((F.col("transaction_type") != "Journal") | journal_ok)
    label = line_type(F.col("transaction_type"), F.col("account_name"), F.col("tax_line_id").isNotNull())
    return (
        rows.withColumn("line_type", label)
        .withColumnsRenamed({"transaction_number": "document_number", "entity_id": "customer_id", "item_count": "quantity"})
        .drop("__source_type", "tax_line_id", "account_name", "account_number", "account_full_name", "header_last_modified")
    )


def po_extract(
    tables: Mapping[str, DataFrame], subsidiary: Any, watermark: str | dt.datetime, absent: Collection[str] = ()
) -> DataFrame:
    """Purchase-order lines whose line or header was modified since the watermark."""
    headers = join_sides(
        _headers(tables, ["Purchase Order"], absent),
        [
            _source_document(tables, ref_trx_number="transaction_number", ref_trx_type="transaction_type"),
            _address(tables, {"bill": "bill", "ship": "ship"}, absent),
        ],
    )
    since = ts_lit(watermark)
    lines = _lines(tables, subsidiary).withColumnRenamed("date_last_modified", "line_last_modified")
    rows = _with_header(lines, headers).filter(
        (F.col("line_last_modified") >= since) | (F.col("header_last_modified") >= since)
    )
    rows = join_sides(rows, _tax_and_account(tables, tax_amount="amount_foreign"))
    label = line_type(F.lit("Purchase Order"), F.col("account_name"), F.col("tax_line_id").isNotNull())
    out = rows.withColumns({"line_type": label, "po_type": code_decode("custom_form_id", PO_FORMS)})
    out = clean_line_breaks(out, [c for c in ("transaction_number", "approval_status", "document_status") if c in out.columns])
    return out.withColumnsRenamed(
        {
            "transaction_number": "po_number",
            "entity_id": "vendor_id",
            "document_status": "po_status",
            "sales_rep": "requestor_id",
            "header_last_modified": "date_last_modified",
        }
    ).drop("tax_line_id", "account_name", "account_number", "account_full_name", "line_last_modified", "transaction_type")


def latest_exception(exceptions: DataFrame) -> DataFrame:
    """One row per record of the workflow exceptions: the latest message, all of them by time, and the count.

    A bill with several exceptions would otherwise repeat its lines, and a repeated
    line key breaks the fact comparison.
    """
    told = F.array_sort(F.collect_list(F.struct("created", F.col("exceptions_0").alias("message"))))
    return exceptions.groupBy("record_id").agg(
        F.max_by("exceptions_0", F.struct("created", "exceptions_0")).alias("exception_message"),
        F.transform(told, lambda x: x["message"]).alias("exception_messages"),
        F.count(F.lit(1)).alias("exception_count"),
    )


def vendor_bill_extract(
    tables: Mapping[str, DataFrame],
    subsidiary: Any,
    watermark: str | dt.datetime,
    forms: Mapping[int, str] | None = None,
    absent: Collection[str] = (),
) -> DataFrame:
    """Vendor-bill lines with country names, terms and workflow exceptions.

    ``forms`` names the custom forms; an unlisted form is 'not available'.
    """
    headers = _headers(tables, ["Bill"], absent).filter(F.col("header_last_modified") >= ts_lit(watermark))
    headers = join_sides(
        headers,
        [
            _source_document(tables, ref_trx_number="transaction_number", ref_trx_type="transaction_type"),
            _address(tables, {"bill": "vendor"}, absent),
            Side(
                tables["payment_terms"], [(F.col("payment_terms_id"), "payment_terms_id")], {"__terms": "payment_terms_id"}
            ),
        ],
    )
    headers = join_sides(
        headers, [Side(tables["countries"], [(F.col("vendor_country"), "short_name")], {"__country": "name"})]
    )
    headers = headers.join(
        latest_exception(tables["workflow_exceptions"]), F.col("transaction_id") == F.col("record_id"), "left"
    )
    headers = headers.withColumns(
        {
            "payment_terms_id": F.col("__terms"),
            "vendor_country": F.coalesce("__country", "vendor_country"),
            "match_exception": presence_flag("record_id"),
        }
    ).drop("__terms", "__country", "record_id")
    lines = _lines(tables, subsidiary)
    # The tax item of a bill line comes from its tax row.
    lines = lines.drop("tax_item_id")
    rows = join_sides(
        _with_header(lines.withColumnRenamed("date_last_modified", "line_last_modified"), headers),
        _tax_and_account(tables, tax_item_id="tax_item_id", tax_amount="amount", tax_amount_foreign="amount_foreign"),
    )
    label = line_type(F.lit("Bill"), F.col("account_name"), F.col("tax_line_id").isNotNull())
    out = rows.withColumns({"line_type": label, "vb_type": code_decode("custom_form_id", forms or {}, NA_TEXT)})
    text = ["transaction_number", "ext_ref_number", "document_status", "approval_status"]
    text += [f"vendor_{p}" for p in ADDRESS_PARTS]
    out = clean_line_breaks(out, [c for c in text if c in out.columns])
    out = out.withColumnsRenamed(
        {
            "transaction_number": "vb_number",
            "entity_id": "vendor_id",
            "document_status": "vb_status",
            "bill_requestor_id": "requestor_id",
            "closed": "close_date",
            "line_last_modified": "date_last_modified",
        }
    )
    out = out.drop("tax_line_id", "account_name", "header_last_modified", "transaction_type")
    return out.withColumnRenamed("account_full_name", "account_name")
