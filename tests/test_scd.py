from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestar.operators import scd
from lodestar.operators.diff import image_diff, refreshed_stage
from lodestar.operators.keys import assign_surrogate_keys

SPEC = scd.DimSpec(name="d", key="k", surrogate="sk", scd1=("one",), scd2=("two",), renames={"one": "uno"})
SCHEMA = "k long, one string, two string"
DAY = dt.timedelta(days=1)
T1, T2, T3 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 3)


def load(spark, dim, stage, image, ts, **options):
    pre = spark.createDataFrame(image, SCHEMA)
    images = image_diff(pre, stage if stage is not None else spark.createDataFrame([], SCHEMA), "k", SPEC.scd1, SPEC.scd2)
    out = scd.scd_insert(images, SPEC, ts, None, None) if dim is None else scd.scd_merge(dim, images, SPEC, ts, **options)
    return out, refreshed_stage(images, pre.columns)


@pytest.fixture(scope="module")
def history(spark):
    first, stage1 = load(spark, None, None, [(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, "d", "x")], T1)
    first.cache(), stage1.cache()
    second, stage2 = load(spark, first, stage1, [(1, "A", "x"), (2, "B", "y"), (4, "d", "x"), (5, "", "n")], T2)
    return first, second.cache(), stage2.cache()


def test_first_load_fills_unknown_values(history, rows):
    assert rows(history[0], "k", "uno", "two", "dw_active")[2] == (3, "c", "NA_GDW", "A")


def test_second_load(history, rows):
    got = rows(history[1], "k", "uno", "two", "date_active_from", "date_active_to", "dw_active")
    end = dt.datetime(9999, 12, 31, 23, 59, 59)
    assert got == [
        (1, "A", "x", T1, end, "A"),
        (2, "B", "y", T2, end, "A"),
        (2, "b", "x", T1, T2 - DAY, "I"),
        (3, "c", "NA_GDW", T1, T2 - DAY, "I"),
        (4, "d", "x", T1, end, "A"),
        (5, "NA_GDW", "n", T2, end, "A"),
    ]


def test_surrogates_are_kept_and_unique(history):
    first = {r["k"]: r["sk"] for r in history[0].collect()}
    second = history[1].collect()
    assert len({r["sk"] for r in second}) == len(second)
    assert all(first[r["k"]] == r["sk"] for r in second if r["date_active_from"] == T1)
    assert min(r["sk"] for r in second if r["date_active_from"] == T2) > max(first.values()) > 0


def test_same_image_again_changes_nothing(spark, history, rows):
    again, _ = load(spark, history[1], history[2], [(1, "A", "x"), (2, "B", "y"), (4, "d", "x"), (5, "", "n")], T3)
    assert rows(again) == rows(history[1])


def test_returning_key_starts_a_new_version(spark, history, rows):
    image = [(1, "A", "x"), (2, "B", "y"), (3, "c", "z"), (4, "d", "x"), (5, "", "n")]
    again, _ = load(spark, history[1], history[2], image, T3)
    assert rows(again.filter("k = 3"), "two", "dw_active", "date_active_from") == [("NA_GDW", "I", T1), ("z", "A", T3)]


def test_type1_change_rewrites_every_version(spark, history, rows):
    image = [(1, "A", "x"), (2, "new", "y"), (4, "d", "x"), (5, "", "n")]
    again, _ = load(spark, history[1], history[2], image, T3)
    assert rows(again.filter("k = 2"), "uno", "two") == [("new", "x"), ("new", "y")]


def test_no_gap_with_zero_offset_and_delete_scope(spark, history, rows):
    image = [(1, "A", "z"), (4, "d", "x"), (5, "", "n")]
    out, _ = load(spark, history[1], history[2], image, T3, expire_offset="0 DAY", delete_scope="all")
    ends = rows(out.filter("k in (1, 2) and dw_active = 'I'"), "k", "two", "date_active_to")
    assert ends == [(1, "x", T3), (2, "x", T3), (2, "y", T3)]
    active = out.filter("dw_active = 'A'").groupBy("k").count().filter("count > 1")
    assert active.isEmpty()


def test_merge_equals_the_steps(spark, history, rows):
    dim, stage = history[1], history[2]
    pre = spark.createDataFrame([(1, "A", "z"), (2, "q", "y"), (5, "", "n"), (9, "i", "i")], SCHEMA)
    images = image_diff(pre, stage, "k", SPEC.scd1, SPEC.scd2)
    steps = dim.unionByName(scd.scd_insert(images, SPEC, T3, dim).select(*dim.columns))
    steps = scd.scd2_expire(steps, images, SPEC, T3)
    steps = steps.unionByName(scd.scd_insert(images, SPEC, T3, steps, "update").select(*dim.columns))
    steps = scd.soft_delete(scd.scd1_update(steps, images, SPEC, T3), images, SPEC, T3)
    cols = [c for c in dim.columns if c != "sk"]
    assert rows(scd.scd_merge(dim, images, SPEC, T3), *cols) == rows(steps, *cols)


def test_default_members_are_seeded_once(spark, rows):
    dim = spark.createDataFrame([(0, "zero"), (7, "seven")], "k long, name string")
    members = [{"k": -99, "name": "NA_GDW"}, {"k": 0, "name": "NA_ERR"}]
    once = scd.seed_default_members(dim, members, "k")
    assert rows(once) == [(-99, "NA_GDW"), (0, "zero"), (7, "seven")]
    assert rows(scd.seed_default_members(once, members, "k")) == rows(once)


def test_surrogate_keys_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(5000).withColumn("name", F.concat(F.lit("n"), F.col("id") * 4096))
    existing = spark.createDataFrame([(10,), (-99,)], "sk long")
    one = assign_surrogate_keys(df.repartition(1), "name", "sk", existing, buckets=16)
    many = assign_surrogate_keys(df.repartition(7), "name", "sk", existing, buckets=16)
    assert rows(one) == rows(many)
    stats = one.agg(F.min("sk"), F.countDistinct("sk"), F.max("sk")).first()
    assert stats[0] > 10 and stats[1] == 5000 and stats[2] < 3 * 5000
