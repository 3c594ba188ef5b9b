"""Specs of the fact loads: line types, lookups and loaded columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.functions.reserved import NA_ID, NA_TEXT
from lodestar.operators.extract import current_versions
from lodestar.operators.facts import Lookup


@dataclass(frozen=True)
class LookupSpec:
    """A lookup by dimension name; see ``operators.facts.Lookup``."""

    name: str
    dim: str
    fk: str | tuple[str, ...]
    id: str | tuple[str, ...]
    key: str
    default: int | str = NA_ID
    date: bool = False


@dataclass(frozen=True)
class FactSpec:
    """One fact: its key, the line types it keeps and its lookups.

    ``renames`` maps prestage columns to fact columns; ``text_defaults`` are text
    columns that take 'not available' when NULL; ``constants`` are added as they are.
    ``part_width`` keeps stage and fact in parts of that many consecutive ids of the
    first key column, so that a load only touches the parts of its increment. Ids that
    rise with time keep those few; choose the width for up to some thousand parts.
    ``compare`` names the columns that decide whether a known line has changed. ``stacked``
    resolves all keys in two shuffles, for dimensions too large to broadcast.
    """

    name: str
    lookups: tuple[LookupSpec, ...]
    line_types: tuple[str, ...]
    line_type_column: str = "line_type"
    key: tuple[str, ...] = ("transaction_id", "transaction_line_id")
    renames: Mapping[str, str] = field(default_factory=dict)
    text_defaults: tuple[str, ...] = ()
    constants: Mapping[str, int] = field(default_factory=dict)
    part_width: int | None = None
    compare: tuple[str, ...] | None = None
    stacked: bool = False

    def compared(self, columns: Sequence[str]) -> list[str] | None:
        """Columns whose change makes a new version; all of them without a list."""
        if self.compare is None:
            return None
        absent = [c for c in self.compare if c not in columns]
        if absent:
            raise ValueError(f"{self.name}: the increment lacks compared columns {absent}")
        return [c for c in self.compare if c not in self.key]

    def part(self) -> Column:
        """Part of the stage and fact tables a row belongs to; depends on the key only."""
        if self.part_width is None:
            return F.lit("0")
        return F.floor(F.col(self.key[0]) / self.part_width).cast("string")

    def lines(self, prestage: DataFrame) -> DataFrame:
        """Rows of the increment that belong in the fact."""
        return prestage.filter(F.col(self.line_type_column).isin(*self.line_types))

    def bind(self, dims: Mapping[str, DataFrame], run_ts: str | dt.datetime) -> list[Lookup]:
        """Lookups on the current versions of the given dimensions.

        A dimension without validity columns (dates, periods, types) is taken as is.
        """
        current = {
            name: current_versions(d, run_ts) if "dw_active" in d.columns else d
            for name, d in dims.items()
            if name in {x.dim for x in self.lookups}
        }
        return [Lookup(x.name, current[x.dim], x.fk, x.id, x.key, x.default, x.date) for x in self.lookups]

    def shape(self, rows: DataFrame) -> DataFrame:
        """Fact columns out of resolved rows."""
        filled = rows.withColumns(
            {
                **{c: F.coalesce(F.col(c), F.lit(NA_TEXT)) for c in self.text_defaults if c in rows.columns},
                **{c: F.lit(v) for c, v in self.constants.items()},
            }
        )
        return filled.withColumnsRenamed({a: b for a, b in self.renames.items() if a in rows.columns})


def _date(name: str, fk: str) -> LookupSpec:
    return LookupSpec(name, "dwdate", fk, "date_id", "date_key", date=True)


_SUBSIDIARY = LookupSpec("subsidiary_key", "subsidiaries", "subsidiary_id", "subsidiary_id", "subsidiary_key")
_LOCATION = LookupSpec("location_key", "locations", "location_id", "location_id", "location_key")
_ITEM = LookupSpec("item_key", "items", "item_id", "item_id", "item_key")
_TAX_ITEM = LookupSpec("tax_item_key", "tax_items", "tax_item_id", "item_id", "tax_item_key")
_CURRENCY = LookupSpec("currency_key", "currencies", "currency_id", "currency_id", "currency_key")
_CLASS = LookupSpec("class_key", "classes", "class_id", "class_id", "class_key")
_TERMS = LookupSpec("terms_key", "payment_terms", "payment_terms_id", "payment_terms_id", "payment_term_key")
_COST_CENTER = LookupSpec("cost_center_key", "cost_center", "department_id", "department_id", "department_key")
_VENDOR = LookupSpec("vendor_key", "vendors", "vendor_id", "vendor_id", "vendor_key")
_CREATED = _date("create_date_key", "create_date")


def _employee(name: str, fk: str) -> LookupSpec:
    return LookupSpec(name, "employees", fk, "employee_id", "employee_key")


# The columns that decide whether a known line has changed. Later
# modification times alone do not make a version of these three facts.
PURCHASE_ORDER_COMPARED = (
    "ref_trx_number", "ref_trx_type", "po_number", "vendor_id", "approver_level_one_id", "approver_level_two_id",
    "approval_status", "bill_address_line_1", "bill_address_line_2", "bill_address_line_3", "bill_city", "bill_country",
    "bill_state", "bill_zip", "carrier_id", "requestor_id", "create_date", "currency_id", "custom_form_id",
    "exchange_rate", "location_id", "ship_address_line_1", "ship_address_line_2", "ship_address_line_3", "ship_city",
    "ship_country", "ship_state", "ship_zip", "po_status", "payment_terms_id", "fright_rate", "po_type",
    "subsidiary_id", "department_id", "item_id", "bc_quantity", "bih_quantity", "book_fair_quantity",
    "education_quantity", "nzso_quantity", "trade_quantity", "school_essentials_quantity", "item_count",
    "item_gross_amount", "item_unit_price", "number_billed", "quantity_received_in_shipment", "quantity_returned",
    "expected_receipt_date", "actual_delivery_date", "tax_item_id", "freight_estimate_method_id", "amount",
    "amount_foreign", "net_amount", "net_amount_foreign", "gross_amount", "match_bill_to_receipt",
    "track_landed_cost", "tax_amount", "class_id",
)
VENDOR_BILL_COMPARED = (
    "vb_number", "vendor_id", "ref_trx_number", "ref_trx_type", "account_number", "payment_terms_id", "payment_hold",
    "vb_due_date", "gl_post_date", "vendor_bill_date", "approver_level_one_id", "approver_level_two_id",
    "requestor_id", "subsidiary_id", "department_id", "item_id", "location_id", "exchange_rate",
    "vendor_address_line_1", "vendor_address_line_2", "vendor_address_line_3", "vendor_city", "vendor_country",
    "vendor_state", "vendor_zip", "vb_status", "approval_status", "item_count", "item_gross_amount", "amount",
    "amount_foreign", "net_amount", "net_amount_foreign", "gross_amount", "item_unit_price", "close_date",
    "tax_item_id", "tax_amount", "tax_amount_foreign", "vb_type", "currency_id", "class_id", "match_exception",
    "exception_message",
)
VENDOR_RETURN_COMPARED = (
    "vra_number", "vendor_id", "created_from_id", "ref_trx_number", "created_by_id", "shipment_received_date",
    "create_date", "subsidiary_id", "department_id", "item_id", "location_id", "exchange_rate",
    "vendor_address_line_1", "vendor_address_line_2", "vendor_address_line_3", "vendor_city", "vendor_country",
    "vendor_state", "vendor_zip", "vra_status", "approval_status", "item_count", "item_gross_amount", "amount",
    "amount_foreign", "net_amount", "net_amount_foreign", "gross_amount", "item_unit_price", "quantity_billed",
    "quantity_shipped", "close_date", "tax_item_id", "tax_amount", "tax_amount_foreign", "vra_type", "currency_id",
    "class_id",
)

#: Document ids in one part of a shipped fact: a billion ids make a thousand parts.
DOCUMENT_PART = 1_000_000

PURCHASE_ORDERS = FactSpec(
    name="po_fact",
    part_width=DOCUMENT_PART,
    compare=PURCHASE_ORDER_COMPARED,
    line_types=("PO_LINE",),
    lookups=(
        _VENDOR,
        _employee("requester_key", "requestor_id"),
        _employee("approver_level1_key", "approver_level_one_id"),
        _employee("approver_level2_key", "approver_level_two_id"),
        _CREATED,
        _SUBSIDIARY,
        _date("requested_receipt_date_key", "expected_receipt_date"),
        _date("actual_delivery_date_key", "actual_delivery_date"),
        LookupSpec(
            "freight_estimate_method_key", "freight_estimate", "freight_estimate_method_id",
            "landed_cost_rule_matrix_nz_id", "freight_key",
        ),
        _CURRENCY,
        _LOCATION,
        _ITEM,
        _TERMS,
        _TAX_ITEM,
        _COST_CENTER,
        _CLASS,
        LookupSpec("carrier_key", "carrier", "carrier_id", "carrier_id", "carrier_key"),
    ),
    renames={
        "item_count": "quantity",
        "item_unit_price": "rate",
        "fright_rate": "freight_rate",
        "po_status": "status",
    },
)

VENDOR_BILLS = FactSpec(
    name="vb_fact",
    part_width=DOCUMENT_PART,
    compare=VENDOR_BILL_COMPARED,
    line_types=("VB_LINE",),
    lookups=(
        _VENDOR,
        _CREATED,
        _date("due_date_key", "vb_due_date"),
        _date("gl_post_date_key", "gl_post_date"),
        _date("vendor_bill_date_key", "vendor_bill_date"),
        _date("close_date_key", "close_date"),
        _employee("requester_key", "requestor_id"),
        _employee("approver_level1_key", "approver_level_one_id"),
        _employee("approver_level2_key", "approver_level_two_id"),
        _SUBSIDIARY,
        _LOCATION,
        _ITEM,
        _COST_CENTER,
        _CURRENCY,
        _TERMS,
        _TAX_ITEM,
        _CLASS,
    ),
    renames={
        "ref_trx_number": "source_transaction_number",
        "ref_trx_type": "source_transaction_type",
        "vb_status": "status",
        "item_count": "quantity",
        "item_unit_price": "rate",
    },
    # A bill line has no account of its own: always the 'not available' member.
    constants={"account_key": NA_ID},
)

VENDOR_RETURNS = FactSpec(
    name="vra_fact",
    part_width=DOCUMENT_PART,
    compare=VENDOR_RETURN_COMPARED,
    line_types=("VRA_LINE",),
    lookups=(
        _VENDOR,
        _employee("requester_key", "created_by_id"),
        _CREATED,
        _date("receive_date_key", "shipment_received_date"),
        _date("close_date_key", "close_date"),
        _SUBSIDIARY,
        _LOCATION,
        _COST_CENTER,
        _ITEM,
        _TAX_ITEM,
        _CURRENCY,
        _CLASS,
    ),
    renames={"item_count": "quantity", "item_unit_price": "rate", "vra_status": "status"},
    text_defaults=(
        "vra_number", "ref_trx_number", "vendor_address_line_1", "vendor_address_line_2",
        "vendor_address_line_3", "vendor_city", "vendor_country", "vendor_state", "vendor_zip", "vra_type",
        "vra_status",
    ),
)

REVENUE = FactSpec(
    name="revenue_fact",
    part_width=DOCUMENT_PART,
    line_types=("INV_LINE", "RA_LINE", "CN_LINE", "JN_LINE"),
    lookups=(
        _TERMS,
        LookupSpec("territory_key", "territories", "sales_rep_id", "territory_id", "territory_key"),
        _CURRENCY,
        _date("transaction_date_key", "trandate"),
        LookupSpec("account_key", "accounts", "account_id", "account_id", "account_key"),
        _ITEM,
        _TAX_ITEM,
        _SUBSIDIARY,
        _LOCATION,
        _CLASS,
        LookupSpec("customer_key", "customers", "customer_id", "customer_id", "customer_key"),
        LookupSpec(
            "ref_doc_type_key", "transaction_type", "ref_custom_form_id", "transaction_type_id",
            "transaction_type_key",
        ),
        LookupSpec(
            "document_status_key", "transaction_status", ("document_status", "transaction_type"),
            ("status", "document_type"), "transaction_status_key", NA_TEXT,
        ),
        LookupSpec(
            "document_type_key", "transaction_type", "custom_form_id", "transaction_type_id",
            "transaction_type_key",
        ),
        LookupSpec(
            "accounting_period_key", "accounting_period", "accounting_period_id", "accounting_period_id",
            "accounting_period_key",
        ),
    ),
    renames={"item_unit_price": "rate"},
)

FACTS: dict[str, FactSpec] = {f.name: f for f in (PURCHASE_ORDERS, VENDOR_BILLS, VENDOR_RETURNS, REVENUE)}
