"""Specs of the dimensions that are maintained from snapshots.

The column lists are fixed values: which change opens a new version (type 2) and
which overwrites (type 1) is part of the warehouse's meaning.
"""

from __future__ import annotations

from lodestar.operators.scd import DimSpec

TERRITORIES = DimSpec(
    name="territories",
    key="territory_id",
    surrogate="territory_key",
    scd2=("is_inactive",),
    scd1=("territory", "subsidiary", "subsidiary_id"),
    also_overwrite=("is_inactive",),
    blank="null",
)

CURRENCIES = DimSpec(
    name="currencies",
    key="currency_id",
    surrogate="currency_key",
    scd1=("name", "currency_extid", "is_inactive", "precision_0", "symbol"),
    renames={"is_inactive": "isinactive", "precision_0": "precision"},
)

EMPLOYEES = DimSpec(
    name="employees",
    key="employee_id",
    surrogate="employee_key",
    carried=("name", "full_name", "firstname", "lastname", "initials"),
    scd2=("supervisor_name", "supervisor_id", "approver_id", "approver_name"),
    scd1=(
        "jobtitle", "email", "line1", "line2", "line3", "zipcode", "city", "state", "country",
        "subsidiary", "subsidiary_id", "line_of_business", "line_of_business_id", "location", "location_id",
        "cost_center", "department_id", "hireddate", "releasedate",
    ),
    renames={
        "jobtitle": "job_title",
        "department_id": "cost_center_id",
        "hireddate": "hire_date",
        "releasedate": "release_date",
    },
)

VENDORS = DimSpec(
    name="vendors",
    key="vendor_id",
    surrogate="vendor_key",
    scd2=(
        "billaddress", "shipaddress", "accountnumber", "line1", "line2", "line3", "zipcode", "city", "state",
        "country", "companyname", "currency_name", "currency_id",
    ),
    scd1=(
        "vendor_extid", "name", "email", "full_name", "eft_bill_payment", "is1099eligible", "isinactive",
        "is_person", "line_of_business", "line_of_business_id", "subsidiary_name", "subsidiary", "vendor_type",
    ),
    renames={"is_person": "type", "subsidiary": "subsidiary_id"},
    blank="null",
)

ITEMS = DimSpec(
    name="items",
    key="item_id",
    surrogate="item_key",
    scd2=(
        "class_id", "line_of_business", "department_id", "cost_center", "location_id", "locations",
        "product_category_id", "product_category", "item_type_id", "item_type", "product_classification_id",
        "product_classification", "product_type_anz_id", "product_type", "product_seriesfamily_id",
        "product_seriesfamily",
    ),
    scd1=(
        "name", "allow_drop_ship", "apply_frieght", "asset_account_id", "asset_account_number", "atp_method",
        "available_to_partners", "backorderable", "bill_exch_rate_var_account_id",
        "bill_exch_rate_var_account_number", "bill_price_variance_account_id",
        "bill_price_variance_account_number", "bill_qty_variance_account_id", "bill_qty_variance_account_number",
        "carton_depth", "carton_height", "carton_quantity", "carton_width", "costing_method", "displayname",
        "expense_account_id", "expense_account_number", "featureditem", "full_name", "income_account_id",
        "income_account_number", "isbn_anz_id", "isbn_name", "isinactive", "item_extid", "item_jde_code_id",
        "isbn10", "item_type_id", "jde_item_code", "parent_id", "parent_name", "product_calssification_anz_id",
        "product_category_id", "product_type_anz_id", "publisher_id", "purchasedescription", "salesdescription",
        "selling_rights_id", "serial_number", "type_name", "vendor_id", "vendor_name",
        "vendreturn_variance_account_id",
    ),
    blank="null",
)

CLASSES = DimSpec(
    name="classes",
    key="class_id",
    surrogate="class_key",
    carried=("parent_name",),
    scd2=("parent_id", "accpac_lob_codes", "hyperion_lob_codes", "line_of_business_code"),
    scd1=("name", "isinactive"),
)

SUBSIDIARIES = DimSpec(
    name="subsidiaries",
    key="subsidiary_id",
    surrogate="subsidiary_key",
    carried=("parent_name",),
    scd2=("fiscal_calendar_id", "currency", "base_currency_id", "parent_id"),
    scd1=(
        "name", "isinactive", "edition", "is_elimination", "legal_name", "federal_number",
        "legal_entity_account_code",
    ),
    renames={
        "parent_name": "parent_subsidiary",
        "parent_id": "parent_subsidiary_id",
        "base_currency_id": "currency_id",
        "is_elimination": "elimination",
        "federal_number": "vat_reg_no",
        "legal_entity_account_code": "legal_account_code",
    },
)

TAX_ITEMS = DimSpec(
    name="tax_items",
    key="item_id",
    surrogate="tax_item_key",
    scd2=("income_account_id", "income_account_number", "income_account_name"),
    scd1=("name", "full_name", "description", "rate", "isinactive"),
)

LOCATIONS = DimSpec(
    name="locations",
    key="location_id",
    surrogate="location_key",
    carried=("parent_name", "line_of_business"),
    scd2=("parent_id", "line_of_business_id"),
    scd1=(
        "address", "address_one", "address_two", "address_three", "city", "state", "country", "zipcode",
        "isinactive", "attention", "branch_id", "full_name", "inventory_available",
        "inventory_available_web_store", "is_include_in_supply_planning", "return_address_one",
        "return_address_two", "return_city", "return_state", "return_country", "return_zipcode",
    ),
)

FREIGHT_ESTIMATE = DimSpec(
    name="freight_estimate",
    key="landed_cost_rule_matrix_nz_id",
    surrogate="freight_key",
    scd2=("subsidiary", "subsidiary_id"),
    scd1=("landed_cost_rule_matrix_nz_nam", "description", "is_inactive", "percent_of_cost", "plus_amount"),
    renames={"landed_cost_rule_matrix_nz_nam": "ship_method_name"},
    blank="null",
)

PAYMENT_TERMS = DimSpec(
    name="payment_terms",
    key="payment_terms_id",
    surrogate="payment_term_key",
    scd1=(
        "name", "payment_terms_extid", "percentage_discount", "minimum_days", "is_preferred", "isinactive",
        "discount_days", "days_until_due", "date_driven",
    ),
)

DIMENSIONS: dict[str, DimSpec] = {
    d.name: d
    for d in (
        TERRITORIES, CURRENCIES, EMPLOYEES, VENDORS, ITEMS, CLASSES, SUBSIDIARIES, TAX_ITEMS, LOCATIONS,
        FREIGHT_ESTIMATE, PAYMENT_TERMS,
    )
}

# Parent and class names that some dimensions take along when a version is inserted:
# dimension -> (lookup table, own column, its key, {loaded name: its column}).
ENRICHED: dict[str, tuple[tuple[str, str, str, dict[str, str]], ...]] = {
    "classes": (("classes", "parent_id", "class_id", {"parent_name": "name"}),),
    "subsidiaries": (("subsidiaries", "parent_id", "subsidiary_id", {"parent_name": "name"}),),
    "locations": (
        ("locations", "parent_id", "location_id", {"parent_name": "name"}),
        ("classes", "line_of_business_id", "class_id", {"line_of_business": "name"}),
    ),
}
