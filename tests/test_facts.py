from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestar.operators import facts as f
from lodestar.operators.diff import fact_changes
from lodestar.operators.joins import Side, hot_hashes, join_sides

T1, T2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


@pytest.fixture(scope="module")
def lookups(spark):
    item = spark.createDataFrame([(1, 101), (2, 102), (-99, -99)], "item_id long, item_key long")
    status = spark.createDataFrame([("Open", "Bill", 1), ("NA_GDW", "Bill", 2)], "status string, kind string, sk int")
    day = spark.createDataFrame([("20260101", 20260101), ("0", 0)], "date_id string, date_key int")
    return [
        f.Lookup("item_key", item, "item", "item_id", "item_key"),
        f.Lookup("status_key", status, ("st", "kind"), ("status", "kind"), "sk", "NA_GDW"),
        f.Lookup("day_key", day, "day", "date_id", "date_key", date=True),
    ]


LINES = [
    (1, 1, "Open", "Bill", T1), (2, None, None, "Bill", None), (3, 9, "Open", "Bill", T1),
    (4, 2, "Shut", "Bill", T1), (5, 2, "Open", "Bill", T2),
]
SCHEMA = "id long, item int, st string, kind string, day timestamp_ntz"


@pytest.mark.parametrize("spread", [False, True])
def test_every_line_is_valid_or_rejected(spark, rows, lookups, spread):
    df = spark.createDataFrame(LINES, SCHEMA)
    valid, rejected = f.resolve_keys(df, lookups, spread)
    keys = ["id", "item_key", "status_key", "day_key"]
    assert rows(valid, *keys) == [(1, 101, 1, 20260101), (2, -99, 2, 0)]
    assert rows(rejected, *keys) == [(3, None, 1, 20260101), (4, 102, None, 20260101), (5, 102, 1, None)]


def test_hot_keys_are_spread_and_results_stay_whole(spark):
    n = 6000
    left = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("fk"))
    dim = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 10).alias("sk"))
    side = Side(dim, [(F.col("fk"), "k")], {"sk": "sk"})
    hot = hot_hashes(left, [[F.col("fk")]], 0.05)[0]
    want = left.select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert want in hot and len(hot) <= 20
    spread = join_sides(left, [side], spread=True, hot_share=0.05, salts=8)
    assert "__salt" in spread._jdf.queryExecution().optimizedPlan().toString()
    plain = left.join(dim, F.col("fk") == F.col("k"), "left").select("id", "fk", "sk")
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    inner = join_sides(left, [side], "inner", spread=True, hot_share=0.05)
    assert inner.count() == plain.filter("sk is not null").count()


def test_planning_runs_nothing(spark, lookups):
    df = spark.createDataFrame(LINES, SCHEMA)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job may start here")
    f.resolve_all(df, lookups)
    assert tracker.getJobIdsForGroup("planning") == []
    spark.sparkContext.setJobGroup("rest", "")


def test_versions_and_quarantine(spark, rows, lookups):
    stage = spark.createDataFrame([(1, 2, "Open", "Bill", T1), (2, None, None, "Bill", None), (9, 1, "Open", "Bill", T1)], SCHEMA)
    valid, _ = f.resolve_keys(stage, lookups)
    fact = f.fact_insert(valid, "2025-01-01 00:00:00").cache()
    changes = fact_changes(spark.createDataFrame(LINES, SCHEMA), stage, "id").cache()
    valid, rejected = f.resolve_keys(f.moved_rows(changes), lookups)
    merged = f.fact_merge(fact, valid, changes, ["id"], T1).cache()
    start, end = dt.datetime(2025, 1, 1), dt.datetime(9999, 12, 31, 11, 59, 59)
    assert rows(merged, "id", "item_key", "date_active_from", "date_active_to", "dw_current") == [
        (1, 101, T1, end, 1), (1, 102, start, T1 - dt.timedelta(days=1), 0), (2, -99, start, end, 1), (9, 101, start, end, 1),
    ]
    errors = f.fact_quarantine(rejected, 1, T1).cache()
    assert rows(errors, "runid", "id", "record_status") == [(1, 3, "ERROR"), (1, 4, "ERROR"), (1, 5, "ERROR")]

    more = spark.createDataFrame([(9, 109), (1, 101), (2, 102)], "item_id long, item_key long")
    later = [f.Lookup("item_key", more, "item", "item_id", "item_key"), *lookups[1:]]
    facts, marked = f.reprocess_errors(errors, later, 1, T2)
    assert rows(facts, "id", "item_key", "date_active_from") == [(3, 109, T2)]
    assert rows(marked, "id", "item_key", "record_status") == [(3, 109, "RESOLVED"), (4, 102, "ERROR"), (5, 102, "ERROR")]
    facts, same = f.reprocess_errors(marked, later, 2, T2)
    assert facts.isEmpty() and rows(same) == rows(marked)


@pytest.mark.parametrize("salts", [1, 3, 8])
def test_stacked_lookups_find_the_same_keys(spark, rows, lookups, salts, tmp_path):
    repeated = [lookups[0], f.Lookup("second_key", lookups[0].dim, "other", "item_id", "item_key"), *lookups[1:]]
    lines = [(*r, k % 3 or None) for r in LINES + [(6, None, None, None, None)] * 3 for k in range(20)]
    spark.createDataFrame(lines, SCHEMA + ", other int").write.parquet(str(tmp_path / "lines"))
    df = spark.read.parquet(str(tmp_path / "lines"))
    want, got = f.resolve_all(df, repeated), f.resolve_stacked(df, repeated, salts)
    assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want) and got.count() == len(lines)


def test_stacked_lookups_move_fact_rows_twice(spark, lookups, tmp_path):
    spark.createDataFrame(LINES, SCHEMA).write.parquet(str(tmp_path / "lines"))
    df = spark.read.parquet(str(tmp_path / "lines"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = [f.Lookup(f"{x.name}{i}", x.dim, x.fk, x.id, x.key, x.default, x.date) for i in range(6) for x in lookups]
        plan = f.resolve_stacked(df, many)._jdf.queryExecution().executedPlan().toString()
        chain = f.resolve_all(df, many)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # one exchange of the ids, one of the dimensions, one that brings the keys together
    assert plan.count("Exchange hashpartitioning") == 3 and chain.count("Exchange hashpartitioning") > 12


def test_stacked_lookups_leave_the_line_out_of_the_first_shuffle(spark, lookups, tmp_path):
    spark.createDataFrame(LINES, SCHEMA).write.parquet(str(tmp_path / "lines"))
    found = f.resolve_stacked(spark.read.parquet(str(tmp_path / "lines")), lookups)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    ids = plan[plan.index("Join ") :]
    assert "posexplode" in ids and "line#" not in ids and "line#" in plan


def test_versions_dealt_by_a_part_of_the_key_are_closed_alike(spark, rows):
    fact = f.fact_insert(spark.createDataFrame([(0, 1, "a"), (0, 1, "b"), (1, 2, "c"), (0, 3, "d"), (None, 4, "e")], "deal long, id long, v string"), T1)
    changed = spark.createDataFrame([(0, 1), (0, 3), (None, 4), (0, 9)], "deal long, id long")
    want = f.fact_expire(fact, changed, ["deal", "id"], T2)
    got = f.fact_expire(fact, changed, ["deal", "id"], T2, deal=["deal"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.columns == want.columns and rows(got) == rows(want)
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(deal" in plan
