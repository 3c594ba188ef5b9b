from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodestar.functions import (
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
    line_type,
    presence_flag,
    to_text_timestamp,
)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(1, "a\r\nb", 1.5), (2, "", None), (3, None, 0.0)], "id int, t string, n double")


def test_line_breaks(texts, rows):
    assert rows(clean_line_breaks(texts, ["t"]), "t") == [(None,), ("",), ("a  b",)]
    assert rows(escape_line_breaks(texts, ["t"]), "t") == [(None,), ("",), ("a\\\r\\\nb",)]


def test_fills_differ_on_null_and_empty(texts, rows):
    out = texts.select("id", fill_null("t", "x").alias("a"), fill_empty("t", "x").alias("b"), fill_blank("t", "x").alias("c"))
    assert rows(out.filter("id > 1")) == [(2, "", "x", "x"), (3, "x", None, "x")]


def test_fill_unknown_keeps_types(texts, rows):
    out = fill_unknown(texts, {"t": "NA_GDW", "n": -99})
    assert out.schema["n"].dataType == texts.schema["n"].dataType
    assert rows(out, "id", "t", "n")[1:] == [(2, "NA_GDW", -99.0), (3, "NA_GDW", 0.0)]
    assert rows(fill_unknown(texts, {"t": "NA_GDW"}, empty=False).filter("id = 2"), "t") == [("",)]


def test_code_decode(texts, rows):
    out = texts.select("id", code_decode("t", {"": "blank", None: "none"}).alias("a"), code_decode("id", {1: "one"}, "other").alias("b"))
    assert rows(out) == [(1, None, "one"), (2, "blank", "other"), (3, "none", "other")]
    assert rows(texts.select("id", presence_flag("t"))) == [(1, "YES"), (2, "YES"), (3, "NO")]


def test_dates_and_labels(spark, rows):
    df = spark.sql("select timestamp_ntz'2024-12-30 23:59:59' as d union all select null")
    assert rows(df.select(date_id("d"))) == [("0",), ("20241230",)]
    text = df.select(to_text_timestamp("d").alias("t"))
    assert rows(text.select("t", from_text_timestamp("t").cast("string"))) == [
        (None, None), ("2024-12-30 23:59:59", "2024-12-30 23:59:59"),
    ]
    names = spark.createDataFrame([("1", "a"), (None, "b"), ("2", None)], "n string, f string")
    assert rows(names.select(account_label("n", "f"))) == [("1 a",), ("2",), ("b",)]


@pytest.mark.parametrize(
    "doc,account,taxed,label",
    [
        ("Invoice", "AR-General", True, "INV_HDR"),
        ("Invoice", None, False, "INV_TAX"),
        ("Invoice", None, True, "INV_FRT"),
        ("Invoice", "Revenue-Product", True, "INV_LINE"),
        ("Return Authorization", None, True, "RA_OTH"),
        ("Return Authorization", "Return Authorizations", False, "RA_HDR"),
        ("Return Authorization", "Freight", True, "RA_FRT"),
        ("Credit Memo", "Freight", True, "CN_OTH"),
        ("Journal", "Revenue-Product", True, "JN_LINE"),
        ("Purchase Order", "Purchase Orders", True, "PO_HDR"),
        ("Purchase Order", None, True, "PO_LINE"),
        ("Bill", "x", False, "VB_TAX"),
        ("Estimate", "x", True, None),
    ],
)
def test_line_type(spark, doc, account, taxed, label):
    df = spark.createDataFrame([(doc, account, taxed)], "d string, a string, t boolean")
    assert df.select(line_type(F.col("d"), F.col("a"), F.col("t"))).first()[0] == label
