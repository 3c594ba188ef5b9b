"""One query per operator over the driver tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodestar.functions.columns import (
    account_label,
    clean_line_breaks,
    code_decode,
    date_id,
    escape_line_breaks,
    fill_blank,
    fill_empty,
    fill_null,
    fill_unknown,
    from_text_timestamp,
    presence_flag,
    to_text_timestamp,
    ts_lit,
)
from lodestar.functions.lines import line_type
from lodestar.functions.reserved import NA_ID, NA_TEXT
from lodestar.operators import diff as d, extract as x, facts as f, hierarchy as h, reference as r, scd
from lodestar.operators.joins import Side, join_sides
from lodestar.plans import control, documents, extracts
from lodestar.plans.facts import PURCHASE_ORDERS, REVENUE, VENDOR_BILLS, VENDOR_RETURNS, FactSpec, LookupSpec
from lodestar.plans.load import RunContext, load_dimension, load_fact, replay_dimension, replay_fact
from lodestar.session import cut_lineage, shared_folder
from lodestar.sources.extract_files import latest_file as newest_file, read_extract, write_extract
from lodestar.sources.foreign_extract import read_foreign
from lodestar.sources.ordered_extract import read_ordered_extract, write_ordered_extract
from lodestar.sources.run_store import RunStore
from lodestar.workload.fixtures import (
    ABSENT,
    CUSTOMER,
    CUSTOMER_TYPE1,
    FACT_KEYS,
    LINE_KEY,
    RUN_ID,
    RUN_TS,
    SECOND_RUN_ID,
    SECOND_RUN_TS,
    Source,
    as_text,
    text_key,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: as_text(fn(Source(spark, sf_dir)))
    return fn


# Extract shaping --------------------------------------------------------------


@query
def incremental_extract(s: Source) -> DataFrame:
    rows = x.incremental_extract(s.table("events"), "ts", "2024-01-15 00:00:00", {"event_type": "purchase"})
    return rows.select("event_id", "ts", "user_id", "value")


@query
def modified_line_or_header(s: Source) -> DataFrame:
    headers = s.table("orders").select("o_orderkey", "o_orderdate")
    rows = s.table("lineitem").join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    out = x.incremental_extract(rows, ["l_shipdate", "o_orderdate"], "2001-06-01 00:00:00")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "o_orderdate")


@query
def stamp_run_id(s: Source) -> DataFrame:
    return x.stamp_run_id(s.table("customer"), RUN_ID)


@query
def clean_line_breaks_text(s: Source) -> DataFrame:
    docs = s.table("documents").select("doc_id", F.concat("text", F.lit("\r\nend")).alias("text"))
    return clean_line_breaks(docs, ["text"])


@query
def escape_line_breaks_text(s: Source) -> DataFrame:
    turns = s.table("conversations").select("conv_id", "turn", F.concat("text", F.lit("\r\nend")).alias("text"))
    return escape_line_breaks(turns, ["text"])


@query
def active_only(s: Source) -> DataFrame:
    flagged = s.table("customer").withColumn("is_inactive", F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No"))
    return x.active_only(flagged, "is_inactive")


@query
def effective_now(s: Source) -> DataFrame:
    return s.dim.filter(x.effective_now(RUN_TS)).select("customer_key", "c_custkey", "c_mktsegment")


@query
def latest_per_key(s: Source) -> DataFrame:
    return x.latest_per_key(s.table("lineitem"), LINE_KEY, "l_shipdate")


@query
def document_union(s: Source) -> DataFrame:
    o = s.table("orders")
    parts = [
        o.filter(F.col("o_orderstatus") == code).select(
            F.lit(name).alias("document_type"), F.col("o_orderkey").alias("transaction_id"), F.col("o_totalprice").alias("amount")
        )
        for code, name in (("F", "Invoice"), ("O", "Return Authorization"), ("P", "Credit Memo"))
    ]
    return x.document_union(parts)


@query
def minus_distinct(s: Source) -> DataFrame:
    cols = ["c_mktsegment", "c_nationkey"]
    return x.minus_distinct(s.dim_prestage.select(*cols), s.dim_stage.select(*cols))


def _absent(s: Source, entity: str) -> set[str]:
    """Id columns of an entity that the driver tables have no counterpart for."""
    spec = extracts.EXTRACTS[entity]
    return {p.fk for p in (*spec.required, *spec.lookups)} - set(s.erp_tables[spec.table].columns)


@query
def items_extract(s: Source) -> DataFrame:
    return extracts.extract(extracts.EXTRACTS["items"], s.erp_tables, _absent(s, "items"))


@query
def employees_extract(s: Source) -> DataFrame:
    return extracts.extract(extracts.EXTRACTS["employees"], s.erp_tables, _absent(s, "employees"))


@query
def customers_extract(s: Source) -> DataFrame:
    return extracts.entities(absent=_absent(s, "customers"))["customers"](s.erp_tables)


# Scalar functions -------------------------------------------------------------


@query
def code_decode_values(s: Source) -> DataFrame:
    o = s.table("orders")
    status = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus"))
    return o.select(
        "o_orderkey",
        code_decode("o_orderstatus", {"F": "Final", "O": "Open"}).alias("no_default"),
        code_decode("o_orderstatus", {"F": "Final", "O": "Open"}, "Other").alias("with_default"),
        code_decode(status, {"F": "Final", None: "Missing"}, "Other").alias("null_matched"),
        presence_flag(status).alias("present"),
    )


@query
def fill_unknown_values(s: Source) -> DataFrame:
    segment = F.when(F.col("c_nationkey") == 5, "").when(F.col("c_nationkey") != 6, F.col("c_mktsegment"))
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    rows = s.table("customer").select(
        "c_custkey",
        segment.alias("segment"),
        balance.alias("balance"),
        fill_null(segment, NA_TEXT).alias("null_only"),
        fill_empty(segment, NA_TEXT).alias("empty_only"),
        fill_blank(segment, NA_TEXT).alias("both"),
    )
    return fill_unknown(rows, {"segment": NA_TEXT, "balance": NA_ID})


@query
def line_type_labels(s: Source) -> DataFrame:
    tables = s.revenue_tables
    o = tables["transactions"].select("transaction_id", "transaction_type")
    rows = join_sides(
        tables["transaction_lines"].join(o, "transaction_id"),
        [
            Side(tables["accounts"], [(F.col("account_id"), "account_id")], {"account_name": "name"}),
            Side(
                tables["transaction_tax_detail"],
                [(F.col("transaction_id"), "transaction_id"), (F.col("transaction_line_id"), "transaction_line_id")],
                {"tax_line_id": "transaction_line_id"},
            ),
        ],
    )
    label = line_type(F.col("transaction_type"), F.col("account_name"), F.col("tax_line_id").isNotNull())
    return rows.select("transaction_id", "transaction_line_id", label.alias("line_type"))


@query
def text_timestamps(s: Source) -> DataFrame:
    e = s.table("events").select("event_id", to_text_timestamp("ts").alias("ts_text"))
    back = from_text_timestamp("ts_text")
    return e.select("event_id", "ts_text", (back >= ts_lit("2024-01-15 00:00:00")).alias("is_new"))


@query
def account_label_text(s: Source) -> DataFrame:
    number = F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey").cast("string"))
    return s.table("supplier").select("s_suppkey", account_label(number, "s_name").alias("account_label"))


# Joins ------------------------------------------------------------------------


@query
def parent_lookup(s: Source) -> DataFrame:
    return h.parent_lookup(s.hierarchy, "node_id", "parent_id", {"parent_full_name": "full_name"})


@query
def role_playing_dates(s: Source) -> DataFrame:
    found = f.resolve_all(s.fact_lines, s.lookups[3:])
    return found.select(*LINE_KEY, "order_date_key", "ship_date_key")


@query
def date_key_lookup(s: Source) -> DataFrame:
    shipped = F.when(F.col("l_tax") != 0, F.col("l_shipdate"))
    days = s.table("lineitem").select(date_id(shipped).alias("day"))
    side = Side(s.date_dim, [(F.col("day"), "date_id")], {"date_key": "date_key"})
    return join_sides(days, [side]).groupBy("day", "date_key").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def created_from_semi(s: Source) -> DataFrame:
    t = s.revenue_tables["transactions"]
    sources = t.filter(F.col("transaction_type").isin("Sales Order", "Invoice")).select(
        F.col("transaction_id").alias("created_from_id")
    )
    memos = t.filter(F.col("transaction_type") == "Credit Memo")
    return memos.join(sources, "created_from_id", "left_semi").select("transaction_id", "transaction_number", "created_from_id")


@query
def items_without_tax(s: Source) -> DataFrame:
    taxed = s.table("lineitem").filter(F.col("l_tax") == 0.08).select(F.col("l_partkey").alias("p_partkey")).distinct()
    return s.table("part").join(taxed, "p_partkey", "left_anti").select("p_partkey", "p_name", "p_brand")


@query
def period_rollup(s: Source) -> DataFrame:
    return r.period_rollup(s.periods)


@query
def accounting_periods_extract(s: Source) -> DataFrame:
    """Periods under their output names; every fifth period is inactive, whatever its level."""
    id = F.col("accounting_period_id")
    bounds = {"starting": F.concat(F.lit("from "), "name"), "ending": F.concat(F.lit("to "), "name")}
    periods = s.periods.withColumns({"isinactive": F.when(id % 5 == 0, "Yes").otherwise("No"), **bounds})
    return extracts.entities("driver calendar")["accounting_period"]({"accounting_periods": periods})


@query
def junk_dimension(s: Source) -> DataFrame:
    def codes(table: str, column: str) -> DataFrame:
        found = s.table(table).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return r.code_list(found.withColumn("id", text_key(F.col(column))), "id", column)

    return r.junk_dimension(
        {
            "status": codes("orders", "o_orderstatus"),
            "priority": codes("orders", "o_orderpriority"),
            "return_flag": codes("lineitem", "l_returnflag"),
            "line_status": codes("lineitem", "l_linestatus"),
            "segment": codes("customer", "c_mktsegment"),
        }
    )


# Change capture and dimensions ------------------------------------------------


def _images(s: Source) -> DataFrame:
    return d.image_diff(s.dim_prestage, s.dim_stage, "c_custkey", CUSTOMER.scd1, CUSTOMER.scd2)


def _moved(images: DataFrame) -> DataFrame:
    """The changed keys only, written once: a merge reads them more than once."""
    return cut_lineage(images.filter(F.col("op") != d.NOCHANGE))


@query
def snapshot_diff(s: Source) -> DataFrame:
    return d.snapshot_diff(s.dim_prestage, s.dim_stage, "c_custkey", CUSTOMER.scd1, CUSTOMER.scd2)


@query
def classify_changes(s: Source) -> DataFrame:
    return d.classify_changes(s.dim_prestage, s.dim_stage, "c_custkey", CUSTOMER.scd1, CUSTOMER.scd2)


@query
def delta_counts(s: Source) -> DataFrame:
    return d.delta_counts(d.snapshot_diff(s.dim_prestage, s.dim_stage, "c_custkey", CUSTOMER.scd1, CUSTOMER.scd2))


@query
def stage_refresh(s: Source) -> DataFrame:
    return d.stage_refresh(s.dim_prestage, s.dim_stage, "c_custkey", [*CUSTOMER.scd1, *CUSTOMER.scd2])


@query
def dim_stage_refresh(s: Source) -> DataFrame:
    return d.dim_stage_refresh(s.dim_stage, _moved(_images(s)), "c_custkey")


@query
def scd_insert(s: Source) -> DataFrame:
    return scd.scd_insert(_images(s), CUSTOMER, RUN_TS, s.dim)


@query
def scd2_expire(s: Source) -> DataFrame:
    return scd.scd2_expire(s.dim, _images(s), CUSTOMER, RUN_TS)


@query
def scd1_update(s: Source) -> DataFrame:
    return scd.scd1_update(s.dim, _images(s), CUSTOMER, RUN_TS)


@query
def soft_delete(s: Source) -> DataFrame:
    return scd.soft_delete(s.dim, _images(s), CUSTOMER, RUN_TS)


@query
def soft_delete_all_versions(s: Source) -> DataFrame:
    images = d.image_diff(
        s.dim_prestage.filter(F.col("c_nationkey") != 6), s.dim_stage, "c_custkey", CUSTOMER.scd1, CUSTOMER.scd2
    )
    return scd.soft_delete(s.dim, images, CUSTOMER, RUN_TS, delete_scope="all")


@query
def scd2_merge(s: Source) -> DataFrame:
    return scd.scd_merge(s.dim, _moved(_images(s)), CUSTOMER, RUN_TS)


@query
def scd1_only(s: Source) -> DataFrame:
    images = d.image_diff(s.dim_prestage, s.dim_stage, "c_custkey", CUSTOMER_TYPE1.scd1)
    return scd.scd_merge(s.dim, _moved(images), CUSTOMER_TYPE1, RUN_TS)


@query
def seed_default_members(s: Source) -> DataFrame:
    dim = s.table("supplier").select("s_suppkey", "s_name", (F.col("s_suppkey") + 1).alias("supplier_key"))
    members = [
        {"s_suppkey": -99, "s_name": "NA_GDW", "supplier_key": -99},
        {"s_suppkey": 0, "s_name": "NA_ERR", "supplier_key": 0},
    ]
    return scd.seed_default_members(dim, members, "s_suppkey")


# Facts ------------------------------------------------------------------------


def _fact_diff(s: Source) -> DataFrame:
    return d.fact_diff(s.fact_prestage, s.fact_stage, LINE_KEY)


def _fact_changes(s: Source) -> DataFrame:
    return d.fact_changes(s.fact_prestage, s.fact_stage, LINE_KEY)


@query
def fact_diff(s: Source) -> DataFrame:
    return _fact_diff(s)


@query
def diff_balance(s: Source) -> DataFrame:
    return d.diff_balance(_fact_diff(s), s.fact_prestage)


@query
def fact_stage_refresh(s: Source) -> DataFrame:
    return d.fact_stage_refresh(s.fact_stage, _fact_changes(s), LINE_KEY)


@query
def fact_stage_refresh_full(s: Source) -> DataFrame:
    compare = [c for c in s.fact_stage.columns if c not in LINE_KEY]
    return d.stage_refresh(s.fact_prestage, s.fact_stage, LINE_KEY, compare, partial=True)


@query
def resolve_keys(s: Source) -> DataFrame:
    found = f.resolve_all(s.fact_lines, s.lookups)
    return found.select(*LINE_KEY, *FACT_KEYS, f.unresolved(s.lookups).alias("rejected"))


@query
def resolve_keys_shuffled(s: Source) -> DataFrame:
    found = f.resolve_all(s.fact_lines, s.lookups, spread=True)
    return found.select(*LINE_KEY, *FACT_KEYS, f.unresolved(s.lookups).alias("rejected"))


@query
def resolve_keys_stacked(s: Source) -> DataFrame:
    found = f.resolve_stacked(s.fact_lines, s.lookups)
    return found.select(*LINE_KEY, *FACT_KEYS, f.unresolved(s.lookups).alias("rejected"))


@query
def fact_insert(s: Source) -> DataFrame:
    rows = f.moved_rows(_fact_changes(s), [d.INSERT])
    valid, _ = f.resolve_keys(rows, s.lookups)
    return f.fact_insert(valid, RUN_TS)


@query
def fact_quarantine(s: Source) -> DataFrame:
    rows = f.moved_rows(_fact_changes(s), [d.INSERT])
    _, rejected = f.resolve_keys(rows, s.lookups)
    return f.fact_quarantine(rejected, RUN_ID, RUN_TS)


@query
def fact_update_quarantine(s: Source) -> DataFrame:
    rows = f.moved_rows(_fact_changes(s), [d.UPDATE])
    _, rejected = f.resolve_keys(rows, s.lookups)
    return f.fact_quarantine(rejected, RUN_ID, RUN_TS)


@query
def fact_expire(s: Source) -> DataFrame:
    changed = _fact_diff(s).filter(F.col("op") == d.UPDATE)
    return f.fact_expire(s.fact, changed, LINE_KEY, RUN_TS)


@query
def fact_version_merge(s: Source) -> DataFrame:
    changes = cut_lineage(_fact_changes(s))
    valid, _ = f.resolve_keys(f.moved_rows(changes), s.lookups)
    return f.fact_merge(s.fact, valid, changes, LINE_KEY, RUN_TS)


def _reprocessed(s: Source) -> tuple[DataFrame, DataFrame]:
    rows = f.moved_rows(_fact_changes(s))
    _, rejected = f.resolve_keys(rows, s.lookups)
    errors = cut_lineage(f.fact_quarantine(rejected, RUN_ID, RUN_TS))
    return f.reprocess_errors(errors, s.later_lookups, RUN_ID, SECOND_RUN_TS)


@query
def reprocess_errors(s: Source) -> DataFrame:
    return _reprocessed(s)[0]


@query
def reprocess_error_marks(s: Source) -> DataFrame:
    return _reprocessed(s)[1].select("runid", *LINE_KEY, *FACT_KEYS, "record_status")


def _errors_of_two_runs(s: Source) -> DataFrame:
    """Rejected lines of a run, and the even ones rejected once more with another quantity."""
    _, rejected = f.resolve_keys(f.moved_rows(_fact_changes(s)), s.lookups)
    first = cut_lineage(f.fact_quarantine(rejected, RUN_ID, RUN_TS))
    again = first.filter("l_linenumber % 2 = 0").withColumns({"l_quantity": F.col("l_quantity") + 1, "runid": F.lit(SECOND_RUN_ID)})
    return cut_lineage(first.unionByName(again))


@query
def reprocess_all_errors(s: Source) -> DataFrame:
    return f.reprocess_all_errors(_errors_of_two_runs(s), s.later_lookups, LINE_KEY, SECOND_RUN_TS)[0]


@query
def reprocess_all_marks(s: Source) -> DataFrame:
    marked = f.reprocess_all_errors(_errors_of_two_runs(s), s.later_lookups, LINE_KEY, SECOND_RUN_TS)[1]
    return marked.select("runid", *LINE_KEY, "l_quantity", "record_status")


@query
def revenue_fact(s: Source) -> DataFrame:
    out = documents.revenue_extract(s.revenue_tables, 27, "1996-01-01 00:00:00", ABSENT)
    return out.select(
        "document_number", "transaction_id", "transaction_line_id", "transaction_type", "ref_doc_number",
        "ref_custom_form_id", "customer_id", "sales_rep_id", "bill_country", "ship_city", "account_id", "item_id",
        "quantity", "amount", "tax_amount", "trandate", "date_last_modified", "line_type",
    )


@query
def po_fact(s: Source) -> DataFrame:
    out = documents.po_extract(s.purchase_tables, 27, "1998-01-01 00:00:00", ABSENT)
    return out.select(
        "po_number", "transaction_id", "transaction_line_id", "ref_trx_number", "ref_trx_type", "vendor_id",
        "bill_address_line_1", "po_status", "po_type", "item_id", "item_count", "amount", "tax_amount",
        "date_last_modified", "line_type",
    )


@query
def vendor_bill_fact(s: Source) -> DataFrame:
    forms = {199: "Drop ship bill", 50: "Standard bill"}
    out = documents.vendor_bill_extract(s.purchase_tables, 27, "1998-01-01 00:00:00", forms, ABSENT)
    return out.select(
        "vb_number", "transaction_id", "transaction_line_id", "ref_trx_number", "vendor_id", "payment_terms_id",
        "account_name", "account_number", "vendor_address_line_1", "vendor_country", "tax_item_id", "tax_amount",
        "vb_type", "match_exception", "exception_message", "exception_count", "date_last_modified", "line_type",
    )


def _loaded(s: Source, spec: FactSpec, prestage: DataFrame) -> DataFrame:
    """Resolved lines of a fact; ids the driver tables have no counterpart for are NULL."""
    fks = [c for lk in spec.lookups for c in ([lk.fk] if isinstance(lk.fk, str) else lk.fk)]
    dates = {lk.fk for lk in spec.lookups if lk.date}
    missing = {c: F.lit(None).cast("timestamp_ntz" if c in dates else "long") for c in fks if c not in prestage.columns}
    rows = spec.lines(prestage.withColumns(missing))
    lookups = spec.bind(s.fact_dims, RUN_TS)
    found = f.resolve_all(rows, lookups).withColumn("rejected", f.unresolved(lookups))
    return spec.shape(found)


def _keys_of(spec: FactSpec, loaded: DataFrame, *more: str) -> DataFrame:
    return loaded.select(*spec.key, *[lk.name for lk in spec.lookups], *more, "rejected")


@query
def revenue_fact_load(s: Source) -> DataFrame:
    prestage = documents.revenue_extract(s.revenue_tables, 27, "1996-01-01 00:00:00", ABSENT)
    return _keys_of(REVENUE, _loaded(s, REVENUE, prestage), "quantity")


@query
def po_fact_load(s: Source) -> DataFrame:
    prestage = documents.po_extract(s.purchase_tables, 27, "1998-01-01 00:00:00", ABSENT)
    return _keys_of(PURCHASE_ORDERS, _loaded(s, PURCHASE_ORDERS, prestage), "quantity", "status")


@query
def vendor_bill_fact_load(s: Source) -> DataFrame:
    prestage = documents.vendor_bill_extract(s.purchase_tables, 27, "1998-01-01 00:00:00", absent=ABSENT)
    return _keys_of(VENDOR_BILLS, _loaded(s, VENDOR_BILLS, prestage), "account_key", "source_transaction_number")


@query
def vendor_return_fact_load(s: Source) -> DataFrame:
    return _keys_of(VENDOR_RETURNS, _loaded(s, VENDOR_RETURNS, s.return_prestage), "vra_number", "quantity")


def _two_runs(spec: FactSpec, rows: DataFrame, amount: str) -> DataFrame:
    """Counts of a second increment: every line has a later modification time, a tenth of the documents another amount.

    Compared columns that the driver tables have no counterpart for are NULL in both.
    """
    absent = [c for c in spec.compare if c not in rows.columns]
    first = rows.withColumns({c: F.lit(None).cast("string") for c in absent})
    later = F.when(F.col("transaction_id") % 10 == 0, F.col(amount) + 1).otherwise(F.col(amount))
    second = first.withColumns({amount: later, "date_last_modified": F.expr("timestamp_ntz'2030-01-01 00:00:00'")})
    return d.delta_counts(d.fact_changes(second, first, list(spec.key), spec.compared(first.columns)))


@query
def po_fact_two_runs(s: Source) -> DataFrame:
    rows = documents.po_extract(s.purchase_tables, 27, "1998-01-01 00:00:00", ABSENT)
    return _two_runs(PURCHASE_ORDERS, rows, "amount")


@query
def vendor_bill_fact_two_runs(s: Source) -> DataFrame:
    rows = documents.vendor_bill_extract(s.purchase_tables, 27, "1998-01-01 00:00:00", absent=ABSENT)
    return _two_runs(VENDOR_BILLS, rows, "amount")


@query
def vendor_return_fact_two_runs(s: Source) -> DataFrame:
    return _two_runs(VENDOR_RETURNS, s.return_prestage.withColumn("date_last_modified", F.col("create_date")), "item_count")


# Hierarchies ------------------------------------------------------------------


def _edges(s: Source) -> DataFrame:
    return h.parent_lookup(s.hierarchy, "node_id", "parent_id", {"parent_full_name": "full_name"})


@query
def hierarchy_depth(s: Source) -> DataFrame:
    return h.hierarchy_depth(_edges(s), "node_id", "parent_id")


@query
def hierarchy_closure(s: Source) -> DataFrame:
    return h.hierarchy_closure(_edges(s), "node_id", "parent_id", {"parent_full_name": "full_name"})


@query
def hierarchy_closure_update(s: Source) -> DataFrame:
    """The closure of an earlier state, in which nodes had other parents and names or were missing, brought up to date."""
    node = F.col("node_id")
    earlier = s.hierarchy.filter((node % 11 != 5) | (node == 0)).select(
        "node_id",
        F.when(node % 13 == 4, F.concat("full_name", F.lit(" old"))).otherwise(F.col("full_name")).alias("full_name"),
        F.when(node % 7 == 3, F.lit(0).cast("long")).otherwise(F.col("parent_id")).alias("parent_id"),
    )
    before = h.parent_lookup(earlier, "node_id", "parent_id", {"parent_full_name": "full_name"})
    now, attrs = _edges(s), {"parent_full_name": "full_name"}
    closure = cut_lineage(h.hierarchy_closure(before, "node_id", "parent_id", attrs))
    changed = h.changed_nodes(before, now, "node_id")
    return h.hierarchy_closure_update(closure, now, changed, "node_id", "parent_id", attrs)


# Control ----------------------------------------------------------------------


@query
def watermark_read(s: Source) -> DataFrame:
    return control.watermark_read(s.watermarks, "purchase")


@query
def watermark_advance(s: Source) -> DataFrame:
    return control.watermark_advance(s.watermarks, "purchase", "8", "2024-01-15 00:00:00", "2024-02-01 00:00:00")


def _job_log(s: Source) -> DataFrame:
    e = s.table("events")
    return e.select(
        F.col("event_id").alias("job_id"),
        F.col("user_id").cast("int").alias("runid"),
        F.col("event_type").alias("entity"),
        F.when(F.col("event_type") == "error", control.ERROR).otherwise(control.IN_PROGRESS).alias("job_status"),
    )


@query
def job_status(s: Source) -> DataFrame:
    return control.final_status(_job_log(s))


@query
def failed_jobs(s: Source) -> DataFrame:
    return control.failed_jobs(_job_log(s))


@query
def next_run(s: Source) -> DataFrame:
    return s.spark.range(1).select(F.lit(control.next_run_id(_job_log(s))).alias("next_run_id"))


@query
def message_log(s: Source) -> DataFrame:
    counts = d.delta_counts(d.snapshot_diff(s.dim_prestage, s.dim_stage, "c_custkey", CUSTOMER.scd1, CUSTOMER.scd2))
    return control.message_rows(counts, SECOND_RUN_ID, "customer", "27", RUN_TS)


# Loads ------------------------------------------------------------------------

FIRST_RUN_TS = "2000-01-01 00:00:00"


def _contexts(s: Source) -> tuple[RunContext, RunContext]:
    store = RunStore(s.spark, shared_folder(s.spark, "store"))
    return RunContext(store, 1, FIRST_RUN_TS), RunContext(store, 2, RUN_TS)


@query
def ordered_extract(s: Source) -> DataFrame:
    """Two thirds of the rows share two values of the first order column; files of 1,000 rows span them."""
    orders = s.table("orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    path = shared_folder(s.spark, "ordered")
    order = [F.desc_nulls_last("o_orderstatus"), F.asc("o_orderdate"), F.asc("o_orderkey")]
    write_ordered_extract(orders, path, RUN_ID, order, rows_per_file=1000)
    return read_ordered_extract(s.spark, path, RUN_ID, orders.schema).select("runid", "position", *orders.columns)


def foreign_lines(docs: DataFrame) -> DataFrame:
    """Documents as another writer has them: a header per file, raw line breaks quoted or escaped, a bad byte."""

    def escaped(c: str, marks: str) -> Column:
        out = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
        for m in marks:
            out = F.replace(out, F.lit(m), F.lit("\\" + m))
        return out

    text = F.coalesce(escaped("text", ',"\n'), F.lit(""))
    quoted = F.concat(F.lit('"'), F.coalesce(escaped("text", '"'), F.lit("")), F.lit('"'))
    odd = F.concat(F.lit("caf"), F.unhex(F.lit("E9")).cast("string"), F.lit("!"))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, text).otherwise(quoted), odd, F.lit("2026-01-02 03:04:05"))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return docs.select(F.when(first, F.concat(F.lit("doc_id,text,note,\"loaded\nat\"\n"), line)).otherwise(line).alias("value"))


@query
def foreign_extract(s: Source) -> DataFrame:
    path = shared_folder(s.spark, "foreign")
    foreign_lines(s.table("documents")).write.text(path)
    schema = T.StructType.fromDDL("doc_id long, text string, note string, loaded_at timestamp_ntz")
    return read_foreign(s.spark, path, schema).drop("_corrupt_record")


@query
def extract_file_round_trip(s: Source) -> DataFrame:
    customers = s.table("customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    path = shared_folder(s.spark, "extract")
    write_extract(customers, path, RUN_ID)
    return read_extract(s.spark, path, RUN_ID, customers.schema).drop("_corrupt_record")


@query
def extract_text_round_trip(s: Source) -> DataFrame:
    """Texts with breaks, quotes and backslashes, NULL and empty ones, through an extract file."""
    kind = F.col("conv_id") % 6
    odd = F.when(kind == 0, F.concat("text", F.lit('\r\n"q", \\'))).when(kind == 2, "").when(kind == 3, '\\n,""').when(kind == 4, '""')
    text = F.when(kind != 1, F.coalesce(odd, F.col("text")))
    turns = s.table("conversations").select("conv_id", "turn", "role", text.alias("text"))
    texts = s.table("documents").select(F.col("doc_id").alias("conv_id"), F.lit(-1).cast("long").alias("turn"), F.lit("doc").alias("role"), "text")
    rows, path = turns.unionByName(texts), shared_folder(s.spark, "extract")
    write_extract(rows, path, RUN_ID)
    return read_extract(s.spark, path, RUN_ID, rows.schema)


@query
def dimension_two_runs(s: Source) -> DataFrame:
    first, second = _contexts(s)
    for ctx, image in ((first, s.dim_stage), (second, s.dim_prestage)):
        written, _ = load_dimension(ctx, CUSTOMER, image)
        ctx.store.publish(ctx.run_id, written)
    return second.store.read("customer")


@query
def dimension_buckets_two_runs(s: Source) -> DataFrame:
    """A dimension in 16 buckets; the second run moves keys in some of them."""
    first, second = _contexts(s)
    spec = dataclasses.replace(CUSTOMER, buckets=16)
    for ctx, image in ((first, s.dim_stage), (second, s.dim_prestage)):
        written, _ = load_dimension(ctx, spec, image)
        ctx.store.publish(ctx.run_id, written)
    return second.store.read("customer").drop("customer_key")


@query
def latest_file(s: Source) -> DataFrame:
    """Three extracts in turn; the newest file named ``customers_`` tells which of them is read."""
    path = shared_folder(s.spark, "drop")
    customers = s.table("customer")
    for name, rows in (
        ("customers_b", customers.filter("c_acctbal < 0")),
        ("customers_a", customers),
        ("suppliers_a", s.table("supplier")),
    ):
        rows.write.csv(f"{path}/{name}")
    newest = newest_file(s.spark, path, "customers_")
    return s.spark.read.schema(customers.schema).csv(newest.rpartition("/")[0])


def _order_lines() -> FactSpec:
    return FactSpec(
        name="order_lines",
        key=tuple(LINE_KEY),
        line_types=("LINE",),
        lookups=(
            LookupSpec("part_key", "parts", "l_partkey", "p_partkey", "part_key"),
            LookupSpec("supplier_key", "suppliers", "l_suppkey", "s_suppkey", "supplier_key"),
            LookupSpec("customer_key", "customers", "o_custkey", "c_custkey", "customer_key"),
            LookupSpec("order_date_key", "days", "o_orderdate", "date_id", "date_key", date=True),
            LookupSpec("ship_date_key", "days", "l_shipdate", "date_id", "date_key", date=True),
        ),
        part_width=20_000,
    )


def _load_lines(s: Source, runs: Sequence[tuple[RunContext, DataFrame]]) -> dict[str, DataFrame]:
    dims = {"parts": s.part_dim, "suppliers": s.supplier_dim, "customers": s.dim, "days": s.date_dim}
    for ctx, rows in runs:
        written, _ = load_fact(ctx, _order_lines(), rows.withColumn("line_type", F.lit("LINE")), dims, "o_orderdate")
        ctx.store.publish(ctx.run_id, written)
    return dims


@query
def fact_two_runs(s: Source) -> DataFrame:
    first, second = _contexts(s)
    _load_lines(s, ((first, s.fact_stage), (second, s.fact_prestage)))
    return second.store.read("order_lines").drop("line_type")


@query
def reprocess_older_run(s: Source) -> DataFrame:
    """The first of two runs had other quantities and lacked a third of its orders; a later run replays it with the right rows."""
    first, second = _contexts(s)
    wrong = s.fact_stage.filter(F.col("l_orderkey") % 3 != 0).withColumn("l_quantity", F.col("l_quantity") + 7)
    dims = _load_lines(s, ((first, wrong), (second, s.fact_prestage)))
    third = RunContext(first.store, 3, "2026-01-03 00:00:00")
    right = s.fact_stage.withColumn("line_type", F.lit("LINE"))
    written, _ = replay_fact(third, _order_lines(), (first, second), right, lambda run: dims, "o_orderdate")
    third.store.publish(third.run_id, written)
    return third.store.read("order_lines").drop("line_type")


@query
def reprocess_older_dimension_run(s: Source) -> DataFrame:
    """The first of two runs lacked members and had other names; a later run replays it with the right image."""
    first, second = _contexts(s)
    wrong = s.dim_stage.filter(F.col("c_custkey") % 3 != 0).withColumn("c_mktsegment", F.lit("WRONG"))
    for ctx, image in ((first, wrong), (second, s.dim_prestage)):
        written, _ = load_dimension(ctx, CUSTOMER, image)
        ctx.store.publish(ctx.run_id, written)
    third = RunContext(first.store, 3, "2026-01-03 00:00:00")
    written, _ = replay_dimension(third, CUSTOMER, (first, second), s.dim_stage)
    third.store.publish(third.run_id, written)
    return third.store.read("customer")
