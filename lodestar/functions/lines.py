"""Document line classifiers.

A line is a header, tax, item, freight or other line, told apart by the name of
its account and by whether a tax row exists for it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Account names and labels per document type.
REVENUE_ACCOUNT = "Revenue-Product"


@dataclass(frozen=True)
class LineRule:
    """How the lines of one document type are labelled.

    ``no_account`` is the label of a line without an account name (None: such a
    line goes on to the tax test). ``other`` is the label of a taxed line that is
    not on the revenue account; None means the account is not tested at all.
    """

    header_account: str
    prefix: str
    no_account: str | None = None
    other: str | None = None


# Fixed values.
LINE_RULES: dict[str, LineRule] = {
    "Invoice": LineRule("AR-General", "INV", None, "INV_FRT"),
    "Return Authorization": LineRule("Return Authorizations", "RA", "RA_OTH", "RA_FRT"),
    "Credit Memo": LineRule("AR-General", "CN", "CN_OTH", "CN_OTH"),
    "Journal": LineRule("AR-General", "JN", "JN_OTH", "JN_OTH"),
    "Purchase Order": LineRule("Purchase Orders", "PO"),
    "Bill": LineRule("AP-General", "VB"),
}


def _labels(rule: LineRule, account_name: Column, has_tax_row: Column) -> Column:
    out = F.when(account_name == rule.header_account, f"{rule.prefix}_HDR")
    if rule.no_account is not None:
        out = out.when(account_name.isNull(), rule.no_account)
    out = out.when(~has_tax_row, f"{rule.prefix}_TAX")
    if rule.other is None:
        return out.otherwise(f"{rule.prefix}_LINE")
    return out.when(account_name == REVENUE_ACCOUNT, f"{rule.prefix}_LINE").otherwise(rule.other)


def line_type(
    document_type: Column,
    account_name: Column,
    has_tax_row: Column,
    rules: Mapping[str, LineRule] = LINE_RULES,
) -> Column:
    """Label of a line; NULL for a document type without a rule."""
    chain: Column | None = None
    for name, rule in rules.items():
        labels = _labels(rule, account_name, has_tax_row)
        hit = document_type == name
        chain = F.when(hit, labels) if chain is None else chain.when(hit, labels)
    if chain is None:
        raise ValueError("at least one rule is needed")
    return chain
