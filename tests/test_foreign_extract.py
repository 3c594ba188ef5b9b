"""The warehouse's load dialect against a reader that goes byte by byte."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from lodestar.sources.foreign_extract import read_foreign

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
        T.StructField("at", T.TimestampNTZType()), T.StructField("n", T.DecimalType(10, 2)),
    ]
)


def plain(data: str) -> list[list[str]]:
    """Records of one file as lists of raw values."""
    records, value, fields, quoted, i = [], [], [], False, 0
    mark = []  # whether a character of the value is an unescaped quote
    def close():
        text = "".join(value)
        if len(text) >= 2 and mark and mark[0] and mark[-1]:
            text = text[1:-1]
        fields.append(text)
        value.clear()
        mark.clear()
    while i < len(data):
        c = data[i]
        if c == "\\" and i + 1 < len(data):
            value.append(data[i + 1])
            mark.append(False)
            i += 2
            continue
        if c == '"':
            quoted = not quoted
        if c == "," and not quoted:
            close()
        elif c == "\n" and not quoted:
            close()
            records.append(list(fields))
            fields.clear()
        else:
            value.append(c)
            mark.append(c == '"')
        i += 1
    if value or fields:
        close()
        records.append(list(fields))
    return records


def write_value(rng: random.Random, text: str) -> str:
    text = text.replace("\\", "\\\\").replace('"', '\\"')
    if rng.random() < 0.5:
        return '"' + text + '"'
    return text.replace(",", "\\,").replace("\n", "\\\n")


@pytest.mark.parametrize("split", [64, 301, 1 << 20])
def test_records_cut_by_splits(spark, tmp_path, split):
    rng = random.Random(split)
    parts = ["x", "é", "\n", ",", '"', "\\", "\r", " ", "\n\n", "word ", "\ue000", "0"]
    rows = []
    for f in range(3):
        body = 'id,"a\nheader",b,at,n\n'
        for k in range(60):
            a, b = ("".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in "ab")
            rows.append((f * 100 + k, a, b))
            body += f"{f * 100 + k},{write_value(rng, a)},{write_value(rng, b)},2026-03-04 05:06:07,\"1.50\"\n"
        assert [r[:3] for r in plain(body)[1:]] == [[str(i), a, b] for i, a, b in rows[-60:]]
        (tmp_path / f"f{f}.csv").write_bytes(body.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = read_foreign(spark, str(tmp_path), SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["id"], r["a"], r["b"]) for r in got) == rows
    assert {(r["at"], str(r["n"]), r["_corrupt_record"]) for r in got} == {(dt.datetime(2026, 3, 4, 5, 6, 7), "1.50", None)}


def test_defined_cases(spark, tmp_path):
    body = b"id,a,b,at,n\n1,,,,\n2,caf\xe9,\"\",,2\nx,\xff\xfe,q,,\n3,a,b\n4,a,b,not a time,5\n5,\xc3\xa9\xef\xbf\xbd,b,2026-01-01 00:00:00,bad\n6,end,no break,,7"
    (tmp_path / "f.csv").write_bytes(body)
    got = {r["id"]: r for r in read_foreign(spark, str(tmp_path), SCHEMA).collect()}
    assert (got[1]["a"], got[1]["b"], got[1]["at"], got[1]["n"], got[1]["_corrupt_record"]) == ("", "", None, None, None)
    assert got[2]["a"] == "caf?" and got[2]["b"] == ""
    assert got[None]["_corrupt_record"].startswith("x,?") and got[3]["_corrupt_record"] == "3,a,b"
    assert got[4]["_corrupt_record"].startswith("4,") and got[5]["_corrupt_record"].startswith("5,")
    assert got[5]["a"] == "é\ufffd" and got[6]["b"] == "no break" and str(got[6]["n"]) == "7.00"
    whole = read_foreign(spark, str(tmp_path), SCHEMA, header=False)
    assert whole.count() == len(got) + 1
