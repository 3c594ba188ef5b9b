from __future__ import annotations

from hypothesis import HealthCheck, given, settings, strategies as st

from lodestar.operators import diff as d
from lodestar.operators.extract import incremental_extract, latest_per_key, minus_distinct, stamp_run_id

SCHEMA = "k long, one string, two string, extra string"
PRE = [(1, "a", "x", "p"), (2, "b", "x", "p"), (3, "a", "y", "p"), (4, "b", "y", "p"), (5, None, "x", "p"), (6, "", "x", "p"), (8, "n", "n", "p")]
STG = [(1, "a", "x", "s"), (2, "a", "x", "s"), (3, "a", "x", "s"), (4, "a", "x", "s"), (5, None, "x", "s"), (6, None, "x", "s"), (7, "z", "z", "s")]


def test_snapshot_diff(spark, rows):
    out = d.snapshot_diff(spark.createDataFrame(PRE, SCHEMA), spark.createDataFrame(STG, SCHEMA), "k", ["one"], ["two"])
    assert rows(out) == [
        (1, "nochange", None), (2, "update", 1), (3, "update", 2), (4, "update", 2), (5, "nochange", None),
        (6, "update", 1), (7, "delete", None), (8, "insert", None),
    ]


def test_null_keys_never_match(spark, rows):
    pre = spark.createDataFrame([(None, "a", "x", "p"), (1, "a", "x", "p")], SCHEMA)
    stg = spark.createDataFrame([(None, "a", "x", "s")], SCHEMA)
    assert rows(d.snapshot_diff(pre, stg, "k", ["one"], ["two"])) == [(1, "insert", None)]
    diff = d.fact_diff(pre, stg, "k", ["one"])
    assert d.diff_balance(diff, pre).first()["balanced"] is False


def test_stage_refresh_keeps_uncompared_columns_of_unchanged_rows(spark, rows):
    out = d.stage_refresh(spark.createDataFrame(PRE, SCHEMA), spark.createDataFrame(STG, SCHEMA), "k", ["one", "two"])
    assert rows(out, "k", "extra") == [(1, "s"), (2, "p"), (3, "p"), (4, "p"), (5, "s"), (6, "p"), (8, "p")]


def test_moved_keys_are_enough_to_refresh_a_dimension_stage(spark, rows):
    pre, stg = spark.createDataFrame(PRE, SCHEMA), spark.createDataFrame(STG, SCHEMA)
    moved = d.image_diff(pre, stg, "k", ["one"], ["two"]).filter("op != 'nochange'")
    assert rows(d.dim_stage_refresh(stg, moved, "k")) == rows(d.stage_refresh(pre, stg, "k", ["one", "two"]))


def test_partial_image_deletes_nothing(spark, rows):
    pre, stg = spark.createDataFrame(PRE, SCHEMA), spark.createDataFrame(STG, SCHEMA)
    images = d.image_diff(pre, stg, "k", ["one", "two"], partial=True)
    assert rows(images.filter("k = 7"), "op", "in_prestage") == [("nochange", False)]
    full = d.stage_refresh(pre, stg, "k", ["one", "two"], partial=True)
    narrow = d.fact_stage_refresh(stg, d.fact_changes(pre, stg, "k", ["one", "two"]), "k")
    assert rows(full) == rows(narrow)
    assert (7, "z", "z", "s") in rows(full)


def test_counts(spark):
    diff = d.snapshot_diff(spark.createDataFrame(PRE, SCHEMA), spark.createDataFrame(STG, SCHEMA), "k", ["one"], ["two"])
    assert d.delta_counts(diff).first().asDict() == {"ingested": 7, "inserted": 1, "updated": 4, "deleted": 1, "unchanged": 2}


values = st.one_of(st.none(), st.sampled_from(["", "a", "b"]))
images = st.dictionaries(st.integers(0, 8), st.tuples(values, values), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(pre=images, stg=images)
def test_diff_against_brute_force(spark, pre, stg):
    schema = "k long, one string, two string"
    frame = lambda m: spark.createDataFrame([(k, *v) for k, v in m.items()], schema)
    got = {r["k"]: (r["op"], r["ch_type"]) for r in d.snapshot_diff(frame(pre), frame(stg), "k", ["one"], ["two"]).collect()}
    want = {}
    for k in pre.keys() | stg.keys():
        if k not in stg:
            want[k] = ("insert", None)
        elif k not in pre:
            want[k] = ("delete", None)
        else:
            ch = 2 if pre[k][1] != stg[k][1] else 1 if pre[k][0] != stg[k][0] else None
            want[k] = ("update" if ch else "nochange", ch)
    assert got == want


def test_latest_per_key(spark, rows):
    data = [(1, 5, "a"), (1, 7, "a"), (1, 7, "b"), (2, None, "x"), (2, 1, None), (3, None, None)]
    df = spark.createDataFrame(data, "k int, ts int, v string")
    for parts in (1, 5):
        out = latest_per_key(df.repartition(parts), "k", "ts")
        assert out.columns == df.columns
        assert rows(out) == [(1, 7, "b"), (2, 1, None), (3, None, None)]


def test_increment_pushes_its_filter_down(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.sql("select 27 as sub, timestamp_ntz'2024-01-02 00:00:00' as ts, 1 as v union all select 28, timestamp_ntz'2024-01-03 00:00:00', 2").write.parquet(path)
    out = incremental_extract(spark.read.parquet(path), "ts", "2024-01-02 00:00:00", {"sub": 27})
    assert rows(out, "v") == [(1,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "EqualTo(sub,27)" in plan


def test_minus_is_distinct_and_null_safe(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (3, None)], "k int, v string")
    assert rows(minus_distinct(a, b)) == [(1, None), (3, "y")]
    assert stamp_run_id(a, 4).columns == ["runid", "k", "v"]


def test_increment_images_are_those_of_the_latest_rows_in_one_shuffle(spark, rows):
    pre = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, None), (3, 1, "x"), (4, 5, "n"), (5, None, "k"), (5, None, "l"), (None, 1, "z")],
        "k long, ts long, v string",
    )
    stg = spark.createDataFrame([(1, 2, "c"), (2, 1, None), (3, 1, "y"), (5, None, "k"), (6, 1, "s"), (None, 1, "z")], "k long, ts long, v string")
    want = d.image_diff(latest_per_key(pre, "k", "ts"), stg, "k", ["ts", "v"], partial=True)
    numbered = [t.withColumn("deal", t.k % 2) for t in (pre, stg)]
    got = d.increment_images(*numbered, ["deal", "k"], "ts", ["ts", "v"], ["deal"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    picked = ["k", "op", "in_prestage", "new.ts", "new.v", "old.ts", "old.v"]
    assert rows(got, *picked) == rows(want, *picked)
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(deal" in plan
