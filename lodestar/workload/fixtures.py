"""Warehouse inputs derived from the driver tables.

Snapshots differ by attributes of the rows (the nation of a customer, the status of
an order), so every input covers its whole table and grows with it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodestar.functions.columns import date_id, fill_blank, ts_lit
from lodestar.functions.reserved import DIM_OPEN_END, NA_ID, NA_TEXT
from lodestar.operators.extract import current_versions, incremental_extract, latest_per_key
from lodestar.operators.facts import Lookup, fact_insert, resolve_keys
from lodestar.operators.scd import DimSpec
from lodestar.session import cut_lineage


def text_key(c: Column) -> Column:
    """A key of 60 bits from the whole of a text, the same in SQL."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")


RUN_TS = "2026-01-01 00:00:00"
SECOND_RUN_TS = "2026-01-02 00:00:00"
RUN_ID = 1
SECOND_RUN_ID = 2
LINE_KEY = ["l_orderkey", "l_linenumber"]
FACT_KEYS = ["part_key", "supplier_key", "customer_key", "order_date_key", "ship_date_key"]
FACT_WATERMARK = "1997-01-01 00:00:00"
STAGED_UNTIL = "2000-06-01 00:00:00"

CUSTOMER = DimSpec(
    name="customer",
    key="c_custkey",
    surrogate="customer_key",
    carried=("c_nationkey",),
    scd2=("c_mktsegment",),
    scd1=("c_name", "c_acctbal"),
)
CUSTOMER_TYPE1 = DimSpec(
    name="customer", key="c_custkey", surrogate="customer_key", carried=("c_nationkey",),
    scd1=("c_name", "c_acctbal", "c_mktsegment"),
)


#: Columns of transactions and addresses that the driver tables have no counterpart for.
ABSENT = (
    "accounting_period_id", "amount_unbilled", "approval_status", "approver_level_one_id", "approver_level_two_id",
    "bill_address_line_2", "bill_address_line_3", "bill_city", "bill_requestor_id", "bill_state", "bill_zip", "carrier_lebel_id",
    "closed", "create_date", "created_by_id", "currency_id", "due_date", "employee_custom_id", "exchange_rate",
    "external_ref_number", "is_payment_hold", "location_id", "po_approver_id", "revenue_commitment_status", "revenue_status",
    "sales_effective_date", "sales_rep_id", "ship_address_line_1", "ship_address_line_2", "ship_address_line_3", "ship_country",
    "ship_state", "ship_zip", "supplier_create_date",
)


def as_text(df: DataFrame) -> DataFrame:
    """Render timestamps the way extract files do."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss") for c in times})


class Source:
    """The driver tables of one folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # Customer dimension -------------------------------------------------------

    @cached_property
    def dim_prestage(self) -> DataFrame:
        """New image: the customers of nation 0 have left."""
        return self.table("customer").filter(F.col("c_nationkey") != 0)

    @cached_property
    def dim_stage(self) -> DataFrame:
        """Last image: nation 1 was not there yet, nations 2 to 5 looked different."""
        nation = F.col("c_nationkey")
        return (
            self.table("customer")
            .filter(nation != 1)
            .withColumns(
                {
                    "c_acctbal": F.when(nation.isin(2, 4), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")),
                    "c_mktsegment": F.when(nation.isin(3, 4), F.concat("c_mktsegment", F.lit("_OLD")))
                    .when(nation == 5, None)
                    .otherwise(F.col("c_mktsegment")),
                }
            )
        )

    @cached_property
    def dim(self) -> DataFrame:
        """Dimension as loaded from the last image; nations 3 and 6 have an older version."""

        def version(key: Column, segment: Column, start: str, end: str, flag: str) -> Column:
            return F.struct(
                "c_custkey",
                "c_nationkey",
                segment.alias("c_mktsegment"),
                "c_name",
                "c_acctbal",
                ts_lit(start).alias("date_active_from"),
                ts_lit(end).alias("date_active_to"),
                F.lit(flag).alias("dw_active"),
                key.alias("customer_key"),
            )

        current = version(
            F.col("c_custkey") * 2 + 1, fill_blank("c_mktsegment", NA_TEXT), "2000-01-01 00:00:00", DIM_OPEN_END, "A"
        )
        older = version(
            F.col("c_custkey") * 2 + 2, F.lit("OLDEST"), "1999-01-01 00:00:00", "1999-12-31 00:00:00", "I"
        )
        versions = F.when(F.col("c_nationkey").isin(3, 6), F.array(current, older)).otherwise(F.array(current))
        return self.dim_stage.select(F.explode(versions).alias("v")).select("v.*")

    # Fact lines ---------------------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        """One row per order line, written once for all its readers."""
        return cut_lineage(latest_per_key(self.table("lineitem"), LINE_KEY, "l_shipdate"))

    @cached_property
    def fact_lines(self) -> DataFrame:
        """Order lines with header columns and some NULL ids and dates, written once."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        # dealt by order, lines stay where they are for their latest image and for their header
        lines = latest_per_key(self.table("lineitem").repartition("l_orderkey"), LINE_KEY, "l_shipdate")
        rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            *LINE_KEY,
            "l_partkey",
            F.when(F.col("l_discount") != 0, F.col("l_suppkey")).alias("l_suppkey"),
            "o_custkey",
            "o_orderdate",
            F.when(F.col("l_tax") != 0, F.col("l_shipdate")).alias("l_shipdate"),
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
        )
        return cut_lineage(rows)

    @cached_property
    def fact_prestage(self) -> DataFrame:
        """Increment: orders since the watermark."""
        return incremental_extract(self.fact_lines, "o_orderdate", FACT_WATERMARK)

    @cached_property
    def fact_stage(self) -> DataFrame:
        """Lines loaded before; returned lines had another quantity."""
        returned = F.col("l_returnflag") == "R"
        return self.fact_lines.filter(F.col("o_orderdate") < ts_lit(STAGED_UNTIL)).withColumn(
            "l_quantity", F.when(returned, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
        )

    @cached_property
    def part_dim(self) -> DataFrame:
        """One brand has not been loaded."""
        part = self.table("part").filter(F.col("p_brand") != "Brand#7")
        return part.select("p_partkey", (F.col("p_partkey") + 1).alias("part_key"))

    @cached_property
    def full_part_dim(self) -> DataFrame:
        return self.table("part").select("p_partkey", (F.col("p_partkey") + 1).alias("part_key"))

    @cached_property
    def supplier_dim(self) -> DataFrame:
        """The suppliers of nation 9 are missing; 'not available' is a member."""
        supplier = self.table("supplier").filter(F.col("s_nationkey") != 9)
        member = self.spark.createDataFrame([(NA_ID, NA_ID)], "s_suppkey bigint, supplier_key bigint")
        return supplier.select("s_suppkey", (F.col("s_suppkey") + 1).alias("supplier_key")).unionByName(member)

    @cached_property
    def date_dim(self) -> DataFrame:
        """Days on which anything was ordered or shipped, and the member for no date."""
        ordered = self.table("orders").select(date_id("o_orderdate").alias("date_id"))
        shipped = self.table("lineitem").select(date_id("l_shipdate").alias("date_id"))
        none = self.spark.createDataFrame([("0",)], "date_id string")
        days = ordered.unionByName(shipped).distinct().unionByName(none)
        return cut_lineage(days.select("date_id", F.col("date_id").cast("int").alias("date_key")))

    @cached_property
    def lookups(self) -> list[Lookup]:
        return self._lookups(self.part_dim)

    @cached_property
    def later_lookups(self) -> list[Lookup]:
        """The lookups once the missing brand has arrived."""
        return self._lookups(self.full_part_dim)

    def _lookups(self, part_dim: DataFrame) -> list[Lookup]:
        customers = current_versions(self.dim, RUN_TS)
        return [
            Lookup("part_key", part_dim, "l_partkey", "p_partkey", "part_key"),
            Lookup("supplier_key", self.supplier_dim, "l_suppkey", "s_suppkey", "supplier_key"),
            Lookup("customer_key", customers, "o_custkey", "c_custkey", "customer_key"),
            Lookup("order_date_key", self.date_dim, "o_orderdate", "date_id", "date_key", date=True),
            Lookup("ship_date_key", self.date_dim, "l_shipdate", "date_id", "date_key", date=True),
        ]

    @cached_property
    def fact(self) -> DataFrame:
        """Fact as loaded from the lines staged before."""
        valid, _ = resolve_keys(self.fact_stage, self.lookups)
        return fact_insert(valid, "2000-01-01 00:00:00")

    # Documents ----------------------------------------------------------------

    def _transactions(self, kind: Column) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey").alias("transaction_id"),
            F.concat(F.lit("DOC"), F.col("o_orderkey")).alias("transaction_number"),
            kind.alias("transaction_type"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_custkey").alias("entity_id"),
            F.col("o_custkey").alias("created_from_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 199)
            .when(F.col("o_orderpriority") == "2-HIGH", 201)
            .when(F.col("o_orderpriority") == "3-MEDIUM", 50)
            .alias("custom_form_id"),
            F.col("o_orderdate").alias("trandate"),
            F.col("o_orderdate").alias("date_last_modified"),
            (F.col("o_custkey") % 30).alias("payment_terms_id"),
        )

    def _document_tables(self, kind: Column, accounts: Column) -> dict[str, DataFrame]:
        lines = self.lines
        n = self.table("nation")
        nation_id = F.col("n_nationkey").cast("long")
        main = F.col("n_regionkey") == 2
        o = self.table("orders")
        return {
            "transactions": self._transactions(kind),
            "transaction_lines": lines.select(
                F.col("l_orderkey").alias("transaction_id"),
                F.col("l_linenumber").alias("transaction_line_id"),
                (F.col("l_quantity").cast("long") - 1).alias("account_id"),
                F.col("l_partkey").alias("item_id"),
                F.when(F.col("l_linestatus") == "F", 27).otherwise(28).alias("subsidiary_id"),
                F.col("l_quantity").alias("item_count"),
                F.col("l_extendedprice").alias("amount"),
                F.col("l_shipdate").alias("date_last_modified"),
            ),
            "accounts": n.select(
                nation_id.alias("account_id"),
                accounts.alias("name"),
                F.when(main, "4000001").otherwise(F.concat(F.lit("5"), nation_id)).alias("accountnumber"),
                F.when(main, "Product Revenue : Revenue-Product").otherwise(F.col("n_name")).alias("full_name"),
            ),
            "transaction_tax_detail": lines.filter(F.col("l_tax") > 0).select(
                F.col("l_orderkey").alias("transaction_id"),
                F.col("l_linenumber").alias("transaction_line_id"),
                F.col("l_suppkey").alias("tax_item_id"),
                (F.col("l_extendedprice") * F.col("l_tax")).alias("amount"),
                F.col("l_tax").alias("amount_foreign"),
            ),
            "transaction_address": o.select(
                F.col("o_orderkey").alias("transaction_id"),
                F.concat(F.lit("House\n"), F.col("o_custkey")).alias("bill_address_line_1"),
                F.concat(F.lit("NATION_"), F.col("o_custkey") % 30).alias("bill_country"),
                F.col("o_orderpriority").alias("ship_city"),
            ),
            "customers": self.table("customer").select(
                F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("sales_rep_id")
            ),
            "countries": n.select(
                F.col("n_name").alias("short_name"), F.concat(F.lit("Country "), nation_id).alias("name")
            ),
            "payment_terms": n.select(nation_id.alias("payment_terms_id")),
            "workflow_exceptions": self.table("events")
            .filter(F.col("event_type") == "error")
            .select(F.col("user_id").alias("record_id"), F.col("props").alias("exceptions_0"), F.col("ts").alias("created")),
        }

    @cached_property
    def revenue_tables(self) -> dict[str, DataFrame]:
        p = F.col("o_orderpriority")
        kind = (
            F.when(p == "1-URGENT", "Sales Order")
            .when(p == "2-HIGH", "Invoice")
            .when(p == "3-MEDIUM", "Return Authorization")
            .when(p == "4-NOT SPECIFIED", "Credit Memo")
            .otherwise("Journal")
        )
        r = F.col("n_regionkey")
        names = (
            F.when(r == 0, "AR-General")
            .when(r == 1, "Return Authorizations")
            .when(r.isin(2, 3), "Revenue-Product")
            .otherwise(F.col("n_name"))
        )
        return self._document_tables(kind, names)

    @cached_property
    def purchase_tables(self) -> dict[str, DataFrame]:
        st = F.col("o_orderstatus")
        kind = F.when(st == "F", "Purchase Order").when(st == "O", "Bill").otherwise("Sales Order")
        r = F.col("n_regionkey")
        names = F.when(r == 0, "Purchase Orders").when(r == 1, "AP-General").otherwise(F.col("n_name"))
        return self._document_tables(kind, names)

    # Dimensions of the document facts -----------------------------------------

    def _nation_dim(self, id: str, key: str, offset: int = 0) -> DataFrame:
        nation = F.col("n_nationkey").cast("long")
        rows = self.table("nation").select((nation + offset).alias(id), (nation + 1).alias(key))
        return rows.unionByName(self.spark.createDataFrame([(NA_ID, NA_ID)], f"{id} bigint, {key} bigint"))

    def _customer_dim(self, id: str, key: str) -> DataFrame:
        cols = ["date_active_from", "date_active_to", "dw_active"]
        rows = self.dim.select(F.col("c_custkey").alias(id), F.col("customer_key").alias(key), *cols)
        member = self.spark.createDataFrame([(NA_ID, NA_ID)], f"{id} bigint, {key} bigint").select(
            id, key, ts_lit("2000-01-01 00:00:00").alias(cols[0]), ts_lit(DIM_OPEN_END).alias(cols[1]), F.lit("A").alias(cols[2])
        )
        return rows.unionByName(member)

    @cached_property
    def fact_dims(self) -> dict[str, DataFrame]:
        """Every dimension the document facts look keys up in."""
        kinds = self.revenue_tables["transactions"].filter(F.col("transaction_type") != "Journal")
        suppliers = self.supplier_dim
        return {
            "vendors": self._customer_dim("vendor_id", "vendor_key"),
            "customers": self._customer_dim("customer_id", "customer_key"),
            "employees": suppliers.select(F.col("s_suppkey").alias("employee_id"), F.col("supplier_key").alias("employee_key")),
            "tax_items": suppliers.select(F.col("s_suppkey").alias("item_id"), F.col("supplier_key").alias("tax_item_key")),
            "items": self.part_dim.select(F.col("p_partkey").alias("item_id"), F.col("part_key").alias("item_key")),
            "dwdate": self.date_dim,
            "subsidiaries": self._nation_dim("subsidiary_id", "subsidiary_key", 10),
            "transaction_type": self._nation_dim("transaction_type_id", "transaction_type_key", 180),
            "freight_estimate": self._nation_dim("landed_cost_rule_matrix_nz_id", "freight_key"),
            "currencies": self._nation_dim("currency_id", "currency_key"),
            "locations": self._nation_dim("location_id", "location_key"),
            "payment_terms": self._nation_dim("payment_terms_id", "payment_term_key"),
            "cost_center": self._nation_dim("department_id", "department_key"),
            "classes": self._nation_dim("class_id", "class_key"),
            "carrier": self._nation_dim("carrier_id", "carrier_key"),
            "territories": self._nation_dim("territory_id", "territory_key"),
            "accounts": self._nation_dim("account_id", "account_key"),
            "accounting_period": self._nation_dim("accounting_period_id", "accounting_period_key"),
            "transaction_status": cut_lineage(
                kinds.select("status", F.col("transaction_type").alias("document_type"))
                .distinct()
                .withColumn("transaction_status_key", text_key(F.concat_ws("|", "status", "document_type")))
            ),
        }

    @cached_property
    def return_prestage(self) -> DataFrame:
        """Vendor returns: order lines, of which the returned ones are item lines."""
        return self.fact_lines.select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_linenumber").alias("transaction_line_id"),
            F.when(F.col("l_suppkey").isNotNull(), F.concat(F.lit("RET"), F.col("l_orderkey"))).alias("vra_number"),
            F.col("o_custkey").alias("vendor_id"),
            F.col("l_suppkey").alias("created_by_id"),
            F.col("o_orderdate").alias("create_date"),
            F.col("l_shipdate").alias("shipment_received_date"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").alias("item_count"),
            F.when(F.col("l_returnflag") == "R", "VRA_LINE").otherwise("VRA_TAX").alias("line_type"),
        )

    # Source tables of the dimension extracts -----------------------------------

    @cached_property
    def erp_tables(self) -> dict[str, DataFrame]:
        """Nations stand for the small reference tables, parts for items, customers for people."""
        nation = F.col("n_nationkey").cast("long")
        n = self.table("nation").select(nation.alias("id"), F.col("n_name").alias("name"))

        def small(id: str, **columns: str) -> DataFrame:
            return n.select(F.col("id").alias(id), *[F.col(c).alias(a) for a, c in (columns or {"name": "name"}).items()])

        key, size = F.col("p_partkey"), F.col("p_size").cast("long")
        part = self.table("part")
        items = part.select(
            key.alias("item_id"),
            F.concat("p_name", F.lit("\r\n"), key).alias("name"),
            F.when(F.col("p_type") == "ECONOMY", "Yes").otherwise("No").alias("isinactive"),
            size.alias("asset_account_id"),
            (size - 20).alias("expense_account_id"),
            (size % 40).alias("class_id"),
            F.when(key > 0, F.floor(key / 3).cast("long")).alias("parent_id"),
        )
        c = F.col("c_custkey")
        people = self.table("customer").select(
            c.alias("employee_id"),
            F.concat("c_name", F.lit("\n")).alias("full_name"),
            F.when(F.col("c_acctbal") < 0, "Yes").otherwise("No").alias("isinactive"),
            (F.col("c_nationkey").cast("long") + 2).alias("subsidiary_id"),
            F.when(c > 0, F.floor(c / 5).cast("long")).alias("supervisor_id"),
            F.when(c > 9, F.floor(c / 7).cast("long")).alias("approver_id"),
        )
        customers = self.table("customer").select(
            c.alias("customer_id"),
            F.col("c_name").alias("name"),
            F.lit("No").alias("isinactive"),
            F.when(F.col("c_mktsegment") != "BUILDING", "CUSTOMER").otherwise("PROSPECT").alias("category_0"),
            F.when(F.col("c_acctbal") < 0, "No").otherwise("Yes").alias("is_person"),
            F.concat(F.lit("NATION_"), F.col("c_nationkey") + 3).alias("country"),
            F.when(c > 0, F.floor(c / 4).cast("long")).alias("parent_id"),
        )
        return {
            "items": items,
            "employees": people,
            "customers": customers,
            "accounts": n.select(
                F.col("id").alias("account_id"),
                F.when(F.col("id") > 4, F.col("id").cast("string")).alias("accountnumber"),
                F.col("name").alias("full_name"),
            ),
            "classes": small("class_id"),
            "subsidiaries": small("subsidiary_id"),
            "countries": n.select(F.col("name").alias("short_name"), F.concat(F.lit("Country "), "id").alias("name")),
            "tax_items": self.table("lineitem")
            .filter(F.col("l_tax") == 0.08)
            .select(F.col("l_partkey").alias("item_id"))
            .distinct(),
        }

    # Hierarchy and control ----------------------------------------------------

    @cached_property
    def hierarchy(self) -> DataFrame:
        """Customers under each other, four to a parent, below customer 0."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("node_id"),
            F.col("c_name").alias("full_name"),
            F.when(key > 0, F.floor((key - 1) / 4).cast("long")).alias("parent_id"),
        )

    @cached_property
    def periods(self) -> DataFrame:
        """Months, quarters and years in which orders were placed."""
        d = F.col("o_orderdate")
        y, q, m = F.year(d), F.quarter(d), F.month(d)
        year_id, quarter_id, month_id = y * 1000, y * 1000 + q * 100, y * 1000 + q * 100 + m

        def period(id: Column, parent: Column, name: Column, quarter: str, year: str) -> Column:
            return F.struct(
                id.cast("int").alias("accounting_period_id"), parent.cast("int").alias("parent_id"),
                name.alias("name"), F.lit(quarter).alias("quarter"), F.lit(year).alias("year_0"),
            )

        levels = F.array(
            period(month_id, quarter_id, F.concat(F.lit("M"), m, F.lit(" "), y), "No", "No"),
            period(quarter_id, year_id, F.concat(F.lit("Q"), q, F.lit(" "), y), "Yes", "No"),
            period(year_id, F.lit(None), F.concat(F.lit("FY "), y), "No", "Yes"),
        )
        months = self.table("orders").select(F.trunc(d, "month").alias("o_orderdate")).distinct()
        return months.select(F.explode(levels).alias("p")).select("p.*").distinct()

    @cached_property
    def watermarks(self) -> DataFrame:
        """An extract interval per kind of event and user."""
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("fact_name"), F.col("user_id").cast("string").alias("subsidiary_id"))
            .agg(F.min("ts").alias("ext_start_dt"), F.max("ts").alias("ext_end_dt"))
        )
