"""Ordered extracts and the positions they rest on."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from lodestar.operators.ordering import part_offsets, place, sorted_parts
from lodestar.sources.ordered_extract import _ranges, read_ordered_extract, write_ordered_extract

@pytest.fixture(scope="module")
def order(spark):
    return [F.asc_nulls_first("kind"), F.desc("n"), F.asc("id")]


@pytest.fixture(scope="module")
def lines(spark):
    """Half of the rows share one value of both leading columns."""
    kind = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 5))
    n = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 11).cast("int")
    return spark.range(2000).select("id", kind.alias("kind"), n.alias("n"), F.concat(F.lit('a "b"\n'), "id").alias("text"))


def test_files_in_name_order_are_sorted(spark, lines, order, tmp_path):
    write_ordered_extract(lines, str(tmp_path), 3, order[:2], rows_per_file=100)
    found, hot = [], 0
    files = sorted(glob.glob(f"{tmp_path}/runid=3/part-*.csv"))
    for name in files:
        own = [x.split(",") for x in open(name, encoding="utf-8").read().splitlines()[1:]]
        assert len(own) <= 200
        hot += any(x[2] in ("hot", '"hot"') for x in own)
        found += [(x[2].strip('"'), -int(x[3].strip('"'))) for x in own]
    assert len(found) == 2000 and found == sorted(found) and len(files) > 12 and hot > 4


def test_positions_read_back(spark, lines, order, tmp_path):
    write_ordered_extract(lines, str(tmp_path), 1, order, rows_per_file=150)
    got = read_ordered_extract(spark, str(tmp_path), 1, lines.schema).orderBy("position").select("position", "id", "kind", "n", "text").collect()
    want = [tuple(r) for r in lines.orderBy(*order).collect()]
    assert [tuple(r)[1:] for r in got] == want and [r["position"] for r in got] == list(range(2000))


def test_small_files_share_tasks(spark, lines, order, tmp_path):
    """One task a file sent the driver samples and results of every file."""
    write_ordered_extract(lines, str(tmp_path), 1, order, rows_per_file=20)
    files = sorted(glob.glob(f"{tmp_path}/runid=1/part-*.csv"))
    tasks = {name.rpartition("/")[2].split("-")[1] for name in files}
    assert len(files) >= 100 and len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = read_ordered_extract(spark, str(tmp_path), 1, lines.schema).orderBy("position").select("id").collect()
    assert [r[0] for r in got] == [r[0] for r in lines.orderBy(*order).select("id").collect()]


def test_ranges_follow_rows(spark):
    assert _ranges(54_000_000, 1000, 200) == 540 and _ranges(10**9, 10**6, 200) == 1000
    assert _ranges(5000, 1000, 200) == 5 and _ranges(10**6, 10, 8) == 1000 and _ranges(0, 1000, 8) == 1
    assert _ranges(10**12, 10**6, 200) == 99_999


def test_no_sort_in_one_task(lines, order):
    plan = lines.repartitionByRange(7, *order).sortWithinPartitions(*order)._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


def test_empty_table(spark, lines, order, tmp_path):
    write_ordered_extract(lines.limit(0), str(tmp_path), 1, order)
    assert read_ordered_extract(spark, str(tmp_path), 1, lines.schema).isEmpty()


def test_places_within_groups(spark):
    rows = [(g, k % 5) for g in (None, "a", "b") for k in range(40)] * 2
    df = spark.createDataFrame(rows, "g string, v int")
    parts = sorted_parts(df, [F.asc_nulls_first("g"), F.asc("v")])
    placed = place(parts, part_offsets(parts, ["g"]), ["g"]).collect()
    for g in (None, "a", "b"):
        own = sorted((r["position"], r["v"], r["total"]) for r in placed if r["g"] == g)
        assert [o[0] for o in own] == list(range(80)) and [o[1] for o in own] == sorted(o[1] for o in own) and {o[2] for o in own} == {80}
