"""Extracts of the dimensions: one projection over source tables per entity.

``tables`` maps a source table name to its DataFrame. All columns of the main table
are carried, text cleaned of line breaks; joined columns are added under the names
given here. Which columns and joins make up an entity are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from lodestar.functions.columns import account_label, clean_line_breaks, code_decode, escape_line_breaks
from lodestar.operators.extract import active_only
from lodestar.operators.joins import Side, join_sides
from lodestar.operators.reference import code_list, junk_dimension, period_rollup


@dataclass(frozen=True)
class From:
    """Columns taken from another table, one row per ``key``; ``take`` maps output to source."""

    table: str
    fk: str
    key: str
    take: Mapping[str, str]


@dataclass(frozen=True)
class ExtractSpec:
    """One entity: main table, active filter, joins and exclusions.

    ``required`` joins drop rows without a partner, ``lookups`` do not. ``without`` is
    (table, own column, key): rows found there are left out. ``escape`` keeps line
    breaks behind a backslash instead of replacing them.
    """

    table: str
    active: tuple[str, str] | None = None
    lookups: tuple[From, ...] = ()
    required: tuple[From, ...] = ()
    without: tuple[str, str, str] | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    decodes: Mapping[str, tuple[str, Mapping[Any, Any], Any]] = field(default_factory=dict)
    escape: bool = False


def _account(own: str) -> From:
    return From("accounts", own, "account_id", {f"{own.removesuffix('_id')}_number": "account_label"})


CLASS = From("classes", "class_id", "class_id", {"line_of_business": "name"})
DEPARTMENT = From("departments", "department_id", "department_id", {"cost_center": "name"})
ACTIVE = ("isinactive", "No")

EXTRACTS: dict[str, ExtractSpec] = {
    "currencies": ExtractSpec("currencies", active=("is_inactive", "No")),
    "vendors": ExtractSpec(
        "vendors",
        lookups=(
            From("currencies", "currency_id", "currency_id", {"currency_name": "name"}),
            From("classes", "line_of_business_id", "class_id", {"line_of_business": "name"}),
            From("subsidiaries", "subsidiary", "subsidiary_id", {"subsidiary_name": "name"}),
            From("vendor_types", "vendor_type_id", "vendor_type_id", {"vendor_type": "name"}),
        ),
    ),
    "payment_terms": ExtractSpec("payment_terms", active=ACTIVE),
    "subsidiaries": ExtractSpec(
        "subsidiaries",
        active=ACTIVE,
        lookups=(From("currencies", "base_currency_id", "currency_id", {"currency": "name"}),),
        escape=True,
    ),
    "employees": ExtractSpec(
        "employees",
        active=ACTIVE,
        required=(From("subsidiaries", "subsidiary_id", "subsidiary_id", {"subsidiary": "name"}),),
        lookups=(
            From("employees", "supervisor_id", "employee_id", {"supervisor_name": "full_name"}),
            From("employees", "approver_id", "employee_id", {"approver_name": "full_name"}),
            CLASS,
            From("locations", "location_id", "location_id", {"location": "name"}),
            DEPARTMENT,
        ),
    ),
    "items": ExtractSpec(
        "items",
        active=ACTIVE,
        without=("tax_items", "item_id", "item_id"),
        lookups=(
            _account("asset_account_id"),
            _account("bill_exch_rate_var_account_id"),
            _account("bill_price_variance_account_id"),
            _account("bill_qty_variance_account_id"),
            _account("expense_account_id"),
            _account("income_account_id"),
            _account("prod_price_var_account_id"),
            _account("prod_qty_var_account_id"),
            CLASS,
            DEPARTMENT,
            From("isbn", "isbn_id", "isbn_id", {"isbn_name": "isbn_name"}),
            From("locations", "location_id", "location_id", {"locations": "name"}),
            From("items", "parent_id", "item_id", {"parent_name": "name"}),
            From("vendors", "vendor_id", "vendor_id", {"vendor_name": "name"}),
            From("product_category_list", "product_category_id", "list_id", {"product_category": "list_item_name"}),
            From("item_type_list", "item_type_id", "list_id", {"item_type": "list_item_name"}),
            From(
                "product_classification_anz", "product_classification_id", "product_classification_anz_id",
                {"product_classification": "classification_label"},
            ),
            From(
                "product_type_listanz", "product_type_anz_id", "product_type_listanz_id",
                {"product_type": "product_type_listanz_name"},
            ),
            From("product_seriesfamily_list", "product_seriesfamily_id", "list_id", {"product_seriesfamily": "list_item_name"}),
        ),
        renames={"isbn_id": "isbn_anz_id"},
    ),
    "accounts": ExtractSpec(
        "accounts",
        active=ACTIVE,
        lookups=(
            From(
                "accounts", "parent_id", "account_id",
                {"parent_account_name": "full_name", "parent_account_number": "accountnumber"},
            ),
            From("currencies", "currency_id", "currency_id", {"currency_name": "name"}),
            CLASS,
            From("locations", "location_id", "location_id", {"location_name": "name"}),
            From("departments", "department_id", "department_id", {"cost_center_name": "name"}),
        ),
    ),
    "carrier": ExtractSpec("carrier_record", renames={"last_modified_date": "date_last_modified"}),
    "classes": ExtractSpec("classes", active=ACTIVE),
    "cost_center": ExtractSpec("departments", active=ACTIVE),
    "customers": ExtractSpec(
        "customers",
        active=ACTIVE,
        lookups=(
            From("countries", "country", "short_name", {"country_name": "name"}),
            From("currencies", "currency_id", "currency_id", {"currency": "name"}),
            From("classes", "line_of_business_id", "class_id", {"line_of_business": "name", "class_id": "class_id"}),
            From("subsidiaries", "subsidiary_id", "subsidiary_id", {"subsidiary": "name"}),
            From("customer_types", "customer_type_id", "customer_type_id", {"customer_category": "name"}),
            From("payment_terms", "payment_terms_id", "payment_terms_id", {"payment_terms": "name"}),
            From("crmgroup", "sales_rep_id", "group_id", {"territory": "title"}),
            From("customers", "parent_id", "customer_id", {"parent": "name"}),
        ),
        decodes={"customer_type": ("is_person", {"No": "Company"}, "Individual")},
    ),
    "freight_estimate": ExtractSpec(
        "landed_cost_rule_matrix_nz",
        lookups=(From("subsidiaries", "subsidiary_id", "subsidiary_id", {"subsidiary": "name"}),),
    ),
    "locations": ExtractSpec("locations", active=ACTIVE),
    "tax_items": ExtractSpec(
        "tax_items",
        active=ACTIVE,
        lookups=(
            From(
                "accounts", "income_account_id", "account_id",
                {"income_account_number": "accountnumber", "income_account_name": "full_name"},
            ),
        ),
    ),
    "territories": ExtractSpec(
        "sales_territory_custom",
        active=("is_inactive", "F"),
        required=(From("subsidiaries", "subsidiary_id", "subsidiary_id", {"subsidiary": "name"}),),
        renames={"sales_territory_custom_id": "territory_id", "sales_territory_custom_name": "territory"},
    ),
}

# Lists of the combined dimension: output name -> (table, id, name, inactive flag).
BOOK_FAIR_LISTS = {
    "status": ("book_fairs_status", "list_id", "list_item_name", "is_record_inactive"),
    "route": ("book_fairs_truck_routes", "book_fairs_truck_routes_id", "book_fairs_truck_routes_name", "is_inactive"),
    "marker": ("book_fair_abcdo_marker_list", "list_id", "list_item_name", "is_record_inactive"),
    "fair_type": ("fair_type_list", "list_id", "list_item_name", "is_record_inactive"),
    "invoice_option": ("book_fairs_invoice_options", "list_id", "list_item_name", "is_record_inactive"),
}


def _labelled(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, with the combined labels some lookups take."""
    out = dict(tables)
    if "accounts" in out:
        out["accounts"] = out["accounts"].withColumn("account_label", account_label("accountnumber", "full_name"))
    anz = "product_classification_anz"
    if anz in out:
        label = account_label("code", "product_classification_anz_nam")
        out[anz] = out[anz].withColumn("classification_label", label)
    return out


def extract(spec: ExtractSpec, tables: Mapping[str, DataFrame], absent: Collection[str] = ()) -> DataFrame:
    """Rows of one entity. A lookup whose id column the main table lacks is an error, unless ``absent`` names the column."""
    source = _labelled(tables)
    rows = tables[spec.table]
    if spec.active is not None:
        rows = active_only(rows, *spec.active)
    if spec.without is not None:
        table, fk, key = spec.without
        rows = rows.join(source[table].select(F.col(key).alias(fk)), fk, "left_anti")
    text = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    rows = (escape_line_breaks if spec.escape else clean_line_breaks)(rows, text)
    for parts, how in ((spec.required, "inner"), (spec.lookups, "left")):
        missing = [p.fk for p in parts if p.fk not in rows.columns and p.fk not in absent]
        if missing:
            raise ValueError(f"{spec.table} lacks the id columns {missing}")
        sides = [Side(source[p.table], [(F.col(p.fk), p.key)], p.take) for p in parts if p.fk not in absent]
        if sides:
            rows = join_sides(rows, sides, how)
    rows = rows.withColumns({out: code_decode(c, m, d) for out, (c, m, d) in spec.decodes.items()})
    return rows.withColumnsRenamed(dict(spec.renames))


def customers(tables: Mapping[str, DataFrame], absent: Collection[str] = ()) -> DataFrame:
    """Customers proper, with the name of the country instead of its code."""
    kept = {**tables, "customers": tables["customers"].filter(F.col("category_0") == "CUSTOMER")}
    # The parent may be of another category.
    parents = tables["customers"]
    spec = EXTRACTS["customers"]
    own = [p for p in spec.lookups if p.table != "customers"]
    rows = extract(ExtractSpec("customers", spec.active, tuple(own), decodes=spec.decodes), kept, absent)
    rows = join_sides(rows, [Side(parents, [(F.col("parent_id"), "customer_id")], {"parent": "name"})])
    return rows.drop("country", "category_0").withColumnRenamed("country_name", "country")


def items_of_subsidiary(tables: Mapping[str, DataFrame], subsidiary: str, absent: Collection[str] = ()) -> DataFrame:
    """Items mapped to the subsidiary of the given name."""
    chosen = tables["subsidiaries"].filter(F.col("name") == subsidiary).select("subsidiary_id")
    mapped = tables["item_subsidiary_map"].join(chosen, "subsidiary_id", "left_semi").select("item_id")
    kept = tables["items"].join(mapped, "item_id", "left_semi")
    spec = EXTRACTS["items"]
    own = tuple(p for p in spec.lookups if p.table != "items")
    rows = extract(ExtractSpec("items", None, own, without=spec.without), {**tables, "items": kept}, absent)
    if "parent_id" in rows.columns:
        rows = join_sides(rows, [Side(tables["items"], [(F.col("parent_id"), "item_id")], {"parent_name": "name"})])
    return rows.withColumnsRenamed(dict(spec.renames))


def accounting_periods(tables: Mapping[str, DataFrame], calendar: str) -> DataFrame:
    """Active leaf periods with quarter and year names and the calendar's name."""
    rolled = period_rollup(tables["accounting_periods"])
    renames = {"name": "period_name", "starting": "start_date", "ending": "end_date"}
    return active_only(rolled, "isinactive").withColumnsRenamed(renames).withColumn("fiscal_calendar", F.lit(calendar))


def book_fairs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every combination of the active members of the five lists."""
    lists = {
        out: code_list(active_only(tables[table], flag, "F"), id, name)
        for out, (table, id, name, flag) in BOOK_FAIR_LISTS.items()
    }
    return junk_dimension(lists)


def entities(calendar: str = "", absent: Collection[str] = ()) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Extract of every dimension by name; ``absent`` are id columns the source is known to lack."""
    simple = {name: (lambda t, s=spec: extract(s, t, absent)) for name, spec in EXTRACTS.items()}
    return {
        **simple,
        "customers": lambda t: customers(t, absent),
        "accounting_period": lambda t: accounting_periods(t, calendar),
        "book_fairs": book_fairs,
    }
