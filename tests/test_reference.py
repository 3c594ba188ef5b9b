from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodestar.operators.reference import code_list, junk_dimension, period_rollup
from lodestar.plans import control, extracts
from lodestar.plans.dimensions import DIMENSIONS


def test_only_leaves_under_a_quarter_under_a_year(spark, rows):
    data = [
        (1, None, "FY", "No", "Yes"), (2, 1, "Q1", "Yes", "No"), (3, 2, "Jan", "No", "No"), (4, 2, "Feb", "No", "No"),
        (5, 4, "Adj", "No", "No"), (6, 1, "loose", "No", "No"),
    ]
    df = spark.createDataFrame(data, "accounting_period_id int, parent_id int, name string, quarter string, year_0 string")
    assert rows(period_rollup(df), "name", "quarter_name", "year_name") == [("Jan", "Q1", "FY")]


def test_junk_dimension(spark, rows):
    one = code_list(spark.createDataFrame([(1, "a"), (2, "b")], "id int, n string"), "id", "n")
    two = code_list(spark.createDataFrame([(5, "x")], "id int, n string"), "id", "n")
    out = junk_dimension({"one": one, "two": two})
    assert out.columns == ["one_id", "one", "two_id", "two"]
    assert out.count() == 12 and out.distinct().count() == 12
    assert (-99, "NA_GDW", 0, "NA_ERR") in rows(out)
    assert "BroadcastNestedLoopJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_junk_dimension_has_no_cap(spark):
    long = spark.range(12_000).select(F.col("id").alias("list_id"), F.concat(F.lit("n"), "id").alias("list_item_name"))
    two = code_list(spark.createDataFrame([(5, "x")], "id int, n string"), "id", "n")
    assert junk_dimension({"two": two, "long": long}).count() == 36_000


def test_watermarks(spark, rows):
    wm = spark.createDataFrame([("po_fact", "27", None, None), ("vb_fact", "27", None, None)], control.WATERMARK_SCHEMA)
    moved = control.watermark_advance(wm, "po_fact", "27", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert str(control.watermark_value(moved, "po_fact", "27")) == "2024-01-02 00:00:00"
    assert control.watermark_value(moved, "vb_fact", "27") is None
    with pytest.raises(control.MissingWatermark):
        control.watermark_value(moved, "po_fact", "28")


def test_every_entity_has_an_extract(spark):
    """All extracts resolve on source tables that hold just the columns they name."""
    needed: dict[str, set[str]] = {}
    for name, spec in extracts.EXTRACTS.items():
        own = needed.setdefault(spec.table, set())
        own |= {p.fk for p in (*spec.lookups, *spec.required)} | set(spec.renames) | {c for c, _, _ in spec.decodes.values()}
        own |= {spec.active[0]} if spec.active else set()
        own |= {DIMENSIONS[name].key} - set(spec.renames.values()) if name in DIMENSIONS else set()
        for p in (*spec.lookups, *spec.required):
            needed.setdefault(p.table, set()).update({p.key, *p.take.values()})
    needed["accounts"] |= {"accountnumber", "full_name", "account_id"}
    needed["product_classification_anz"] |= {"code", "product_classification_anz_nam"}
    needed["customers"].add("category_0")
    needed["tax_items"].add("item_id")
    needed["items"].add("item_id")
    needed["item_subsidiary_map"] = {"item_id", "subsidiary_id"}
    needed["accounting_periods"] = {"accounting_period_id", "parent_id", "name", "quarter", "year_0", "isinactive"}
    for table, id, name, flag in extracts.BOOK_FAIR_LISTS.values():
        needed[table] = {id, name, flag}
    labels = {"account_label", "classification_label"}
    tables = {t: spark.range(0).select(*[F.lit("1").alias(c) for c in sorted(cols - labels)]) for t, cols in needed.items()}
    found = extracts.entities("calendar")
    assert len(found) == 17
    for name, fn in found.items():
        out = fn(tables)
        spec = DIMENSIONS.get(name)
        assert spec is None or spec.key in out.columns
        assert len(set(out.columns)) == len(out.columns)
    assert extracts.items_of_subsidiary(tables, "x").isEmpty()
    assert found["book_fairs"](tables).count() == 2**5
