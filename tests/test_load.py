from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestar.operators.extract import incremental_extract
from lodestar.operators.scd import DimSpec
from lodestar.plans import control
from lodestar.plans.dimensions import CLASSES, DIMENSIONS
from lodestar.plans.facts import FACTS, FactSpec, LookupSpec
from lodestar.plans.load import (
    Job,
    RunContext,
    enrich,
    increment_job,
    load_dimension,
    load_fact,
    load_hierarchy,
    replay_dimension,
    replay_fact,
    reprocess_all,
    reprocess_fact,
    run_jobs,
    seed_watermarks,
)
from lodestar.sources.run_store import LaterRunExists, RunStore, compact, register_and_analyze
from lodestar.streaming.feed import increment_feed

ITEM = DimSpec(name="items", key="item_id", surrogate="item_key", scd1=("label",), scd2=("kind",))
SALES = FactSpec(
    name="sales",
    key=("doc", "line"),
    lookups=(LookupSpec("item_key", "items", "item_id", "item_id", "item_key"),),
    line_types=("LINE",),
    renames={"amt": "amount"},
    part_width=1,
)
SALE_SCHEMA = "doc long, line int, item_id long, amt double, line_type string, date_last_modified timestamp_ntz"
T = [dt.datetime(2026, 1, d) for d in range(1, 6)]


def items(spark, *rows):
    return spark.createDataFrame([(-99, "NA_GDW", "NA_GDW"), *rows], "item_id long, label string, kind string")


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), SALE_SCHEMA)


def jobs(spark, item_rows, sale_rows, window=None):
    def fact_after_dim(ctx):
        path = ctx.store.path("items", ctx.run_id, ctx.attempt)
        return load_fact(ctx, SALES, sales(spark, *sale_rows), {"items": spark.read.parquet(path)})

    return [
        Job("sales", fact_after_dim, is_dimension=False, watermark=("sales", *window) if window else None),
        Job("items", lambda ctx: load_dimension(ctx, ITEM, items(spark, *item_rows))),
    ]


FIRST_ITEMS = [(1, "one", "a"), (2, "two", "a")]
FIRST_SALES = [
    (10, 1, 1, 5.0, "LINE", T[0]), (10, 2, 2, 6.0, "LINE", T[0]), (10, 3, 1, 1.0, "TAX", T[0]), (11, 1, 3, 7.0, "LINE", T[0]),
    (12, 1, None, 8.0, "LINE", T[0]), (10, 1, 1, 4.0, "LINE", T[0] - dt.timedelta(days=1)),
]
SECOND_ITEMS = [(1, "one", "b"), (2, "zwei", "a"), (3, "three", "a")]
SECOND_SALES = [(10, 1, 1, 5.0, "LINE", T[0]), (10, 2, 2, 9.0, "LINE", T[1]), (13, 1, 3, 1.0, "LINE", T[1])]


@pytest.fixture
def store(spark, tmp_path):
    out = RunStore(spark, str(tmp_path / "dw"))
    seed_watermarks(RunContext(out, 0, T[0], subsidiary="27"), {"sales": "1900-01-01 00:00:00"})
    return out


def test_two_runs(spark, store, rows):
    one = RunContext(store, 1, T[0], subsidiary="27")
    result = run_jobs(one, jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    assert result.status == {"items": "Success", "sales": "Success"}
    fact = ["doc", "line", "amount", "dw_current"]
    assert rows(store.read("sales"), *fact) == [(10, 1, 5.0, 1), (10, 2, 6.0, 1), (12, 1, 8.0, 1)]
    assert rows(store.read("sales_error"), "runid", "doc", "item_id", "record_status") == [(1, 11, 3, "ERROR")]
    assert store.read("stage_sales").count() == 5
    assert control.watermark_value(store.read("watermarks"), "sales", "27") == T[1]

    two = RunContext(store, 2, T[1], subsidiary="27")
    run_jobs(two, jobs(spark, SECOND_ITEMS, SECOND_SALES, (T[1], T[2])))
    snapshot = rows(store.read("sales"), *fact)
    assert snapshot == [(10, 1, 5.0, 1), (10, 2, 6.0, 0), (10, 2, 9.0, 1), (12, 1, 8.0, 1), (13, 1, 1.0, 1)]
    assert rows(store.read("items").filter("item_id > 0"), "item_id", "label", "kind", "dw_active") == [
        (1, "one", "a", "I"), (1, "one", "b", "A"), (2, "zwei", "a", "A"), (3, "three", "a", "A"),
    ]
    keys = store.read("items").filter("dw_active = 'A'").select("item_key")
    new = store.read("sales").filter(F.col("date_active_from") == T[1])
    assert new.join(keys, "item_key", "left_anti").isEmpty()
    log = store.read("job_log")
    assert rows(control.failed_jobs(log)) == [(1, 0), (2, 0)] and control.next_run_id(log) == 3
    notes = store.read("message_log").filter("runid = 2 and target_table = 'sales' and message_stage = 'updated'")
    assert rows(notes, "message_desc") == [("no of records updated --> 1",)]

    # The second increment brought documents 10 and 13: document 12 was not rewritten.
    state, first = store.published()["sales"], store.published(before=2)["sales"]
    assert first.keys() == {"current/10", "current/12"}
    assert state.keys() == {"current/10", "current/12", "current/13", "closed/10/run2"}
    assert state["current/12"] == first["current/12"] and state["current/10"] != first["current/10"]
    stage, first = store.published()["stage_sales"], store.published(before=2)["stage_sales"]
    assert stage["11"] == first["11"] and stage["10"] != first["10"]
    errors = store.published()["sales_error"]
    assert errors.keys() == {"run1", "run2"}

    # The same run once more: same result, nothing twice.
    again = run_jobs(RunContext(store, 2, T[1], attempt=2, subsidiary="27"), jobs(spark, SECOND_ITEMS, SECOND_SALES, (T[1], T[2])))
    assert again.status == {"items": "Success", "sales": "Success"}
    assert rows(store.read("sales"), *fact) == snapshot
    assert store.read("job_log").filter("runid = 2").count() == 2

    # Merging the closed versions leaves the rest alone.
    before = store.published()["sales"]
    assert not compact(store, "sales", 1, 2, failed=0, prefix="closed/")  # one piece: nothing to merge
    assert compact(store, "sales", 1, 2, failed=0)
    after = store.published()["sales"]
    assert after.keys() == before.keys()
    assert rows(store.read("sales"), *fact) == snapshot

    # The quarantined line of run 1 finds its item now.
    three = RunContext(store, 3, T[2], subsidiary="27")
    dims = {"items": store.read("items")}
    result = run_jobs(three, [Job("sales", lambda ctx: reprocess_fact(ctx, SALES, dims, 1), False)], mode="errors")
    assert result.errors == {}
    assert rows(store.read("sales").filter("doc = 11"), "amount", "date_active_from") == [(7.0, T[2])]
    assert rows(store.read("sales_error"), "doc", "record_status") == [(11, "RESOLVED")]


def test_a_failed_dimension_blocks_facts_and_watermarks(spark, store, rows):
    run_jobs(RunContext(store, 1, T[0], subsidiary="27"), jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    before = rows(store.read("sales"))

    def broken(ctx):
        raise RuntimeError("no such table")

    plan = [*jobs(spark, SECOND_ITEMS, SECOND_SALES, (T[1], T[2])), Job("vendors", broken)]
    result = run_jobs(RunContext(store, 2, T[1], subsidiary="27"), plan)
    assert result.status == {"items": "Success", "vendors": "Error", "sales": "Error"}
    assert rows(store.read("sales")) == before
    assert control.watermark_value(store.read("watermarks"), "sales", "27") == T[1]
    assert rows(control.failed_jobs(store.read("job_log"), 2)) == [(2, 2)]


def test_an_empty_increment_succeeds_and_changes_nothing(spark, store, rows):
    run_jobs(RunContext(store, 1, T[0]), jobs(spark, FIRST_ITEMS, FIRST_SALES))
    before = store.published()
    empty = Job("sales", lambda ctx: load_fact(ctx, SALES, sales(spark, *FIRST_SALES).limit(0), {"items": ctx.before("items")}), False)
    result = run_jobs(RunContext(store, 2, T[1]), [empty])
    assert result.status == {"sales": "Success"}
    after = store.published()
    assert after["sales"] == before["sales"] and after["stage_sales"] == before["stage_sales"]
    notes = store.read("message_log").filter("runid = 2")
    assert rows(notes, "message_desc")[0] == ("no of records deleted --> 0",) and notes.count() == 8


def test_only_selected_entities_run(spark, store):
    result = run_jobs(RunContext(store, 1, T[0]), jobs(spark, FIRST_ITEMS, FIRST_SALES), entities=["items"])
    assert result.status == {"items": "Success"} and store.read("sales") is None


def test_superseded_errors_stay_out(spark, store, rows):
    for i, amount in ((1, 7.0), (2, 7.5)):
        line = (11, 1, 3, amount, "LINE", T[i - 1])
        run_jobs(RunContext(store, i, T[i - 1]), jobs(spark, FIRST_ITEMS, [(10, 1, 1, 5.0, "LINE", T[0]), line]))
    run_jobs(RunContext(store, 3, T[2]), jobs(spark, SECOND_ITEMS, [(10, 1, 1, 5.0, "LINE", T[0])]))
    dims = {"items": store.read("items")}
    run_jobs(RunContext(store, 4, T[3]), [Job("sales", lambda ctx: reprocess_fact(ctx, SALES, dims, 1), False)])
    assert store.read("sales").filter("doc = 11").isEmpty()
    run_jobs(RunContext(store, 5, T[4]), [Job("sales", lambda ctx: reprocess_fact(ctx, SALES, dims, 2), False)])
    assert rows(store.read("sales").filter("doc = 11"), "amount") == [(7.5,)]
    assert rows(store.read("sales_error"), "runid", "record_status") == [(1, "SUPERSEDED"), (2, "RESOLVED")]


def test_all_open_errors_are_driven_at_once(spark, store, rows):
    for i, amount in ((1, 7.0), (2, 7.5)):
        lines = [(11, 1, 3, amount, "LINE", T[i - 1]), (12 + i, 1, 3, 1.0 * i, "LINE", T[i - 1]), (20, 1, 99, amount, "LINE", T[i - 1])]
        run_jobs(RunContext(store, i, T[i - 1]), jobs(spark, FIRST_ITEMS, [(10, 1, 1, 5.0, "LINE", T[0]), *lines]))
    run_jobs(RunContext(store, 3, T[2]), jobs(spark, SECOND_ITEMS, [(10, 1, 1, 5.0, "LINE", T[0])]))
    dims = {"items": store.read("items")}
    run_jobs(RunContext(store, 4, T[3]), [Job("sales", lambda ctx: reprocess_all(ctx, SALES, dims), False)])
    assert rows(store.read("sales").filter("doc in (11, 13, 14, 20)"), "doc", "amount") == [(11, 7.5), (13, 1.0), (14, 2.0)]
    assert rows(store.read("sales_error"), "runid", "doc", "record_status") == [
        (1, 11, "SUPERSEDED"), (1, 13, "RESOLVED"), (1, 20, "SUPERSEDED"),
        (2, 11, "RESOLVED"), (2, 14, "RESOLVED"), (2, 20, "ERROR"),
    ]
    run_jobs(RunContext(store, 5, T[4]), [Job("sales", lambda ctx: reprocess_all(ctx, SALES, dims), False)])
    assert rows(store.read("sales").filter("doc = 11 and dw_current = 1"), "amount") == [(7.5,)]


def test_stacked_lookups_load_the_same_fact(spark, tmp_path, rows):
    loaded = []
    for name, spec in (("chain", SALES), ("stacked", dataclasses.replace(SALES, stacked=True))):
        store = RunStore(spark, str(tmp_path / name))
        for i in (0, 1):
            lines = [(10, 1, 1, 5.0 + i, "LINE", T[i]), (11, 1, None, 6.0, "LINE", T[i]), (12, 1, 99, 7.0, "LINE", T[i])]
            known = spark.createDataFrame([(1, 101), (-99, -99)], "item_id long, item_key long")
            frame = spark.createDataFrame(lines, SALE_SCHEMA)
            run_jobs(RunContext(store, i + 1, T[i]), [Job("sales", lambda c: load_fact(c, spec, frame, {"items": known}), False)])
        loaded.append((rows(store.read("sales")), rows(store.read("sales_error"))))
    assert loaded[0] == loaded[1] and loaded[0][0] and loaded[0][1]


def test_an_older_run_is_replayed(spark, tmp_path, rows):
    """Stores with a wrong first run, replayed, and with the right one from the start hold the same."""
    dims = {"items": spark.createDataFrame([(1, 101), (2, 102), (-99, -99)], "item_id long, item_key long")}
    wrong = [(10, 1, 2, 50.0, "LINE", T[0]), (14, 1, 1, 3.0, "LINE", T[0]), (None, 9, 1, 1.0, "LINE", T[0])]
    third = [(10, 2, 1, 9.0, "LINE", T[2]), (11, 1, 1, 7.0, "LINE", T[2])]

    def fill(name, sale_rows, item_rows):
        store = RunStore(spark, str(tmp_path / name))
        runs = [RunContext(store, i + 1, T[i]) for i in range(3)]
        for ctx, lines, members in zip(runs, (sale_rows, SECOND_SALES, third), (item_rows, SECOND_ITEMS, FIRST_ITEMS)):
            plan = [
                Job("sales", lambda c: load_fact(c, SALES, sales(spark, *lines), dims), False, needs=()),
                Job("items", lambda c: load_dimension(c, ITEM, items(spark, *members))),
            ]
            assert run_jobs(ctx, plan).errors == {}
        return store, runs

    right, _ = fill("right", FIRST_SALES, FIRST_ITEMS)
    store, runs = fill("wrong", wrong, [(1, "uno", "x"), (7, "seven", "a")])
    replays = [
        Job("sales", lambda c: replay_fact(c, SALES, runs, sales(spark, *FIRST_SALES), lambda run: dims), False, needs=()),
        Job("items", lambda c: replay_dimension(c, ITEM, runs, items(spark, *FIRST_ITEMS))),
    ]
    old = rows(store.read("sales"))
    assert run_jobs(RunContext(store, 4, T[3]), replays, mode="replay").errors == {}
    for table in ("sales", "sales_error", "stage_sales", "items", "stage_items", "items_rejected", "received_sales", "received_items"):
        assert rows(store.read(table)) == rows(right.read(table)), table
    assert store.read("sales_rejected").isEmpty()
    assert rows(store.read("sales", before=4)) == old != rows(store.read("sales"))
    result = run_jobs(RunContext(store, 5, T[4]), [Job("sales", lambda c: replay_fact(c, SALES, runs[:2], sales(spark, *wrong), lambda run: dims), False)])
    assert "takes the runs [1, 2, 3] of received_sales" in result.errors["sales"]


def test_a_failure_blocks_only_what_needs_it(spark, store, rows):
    def broken(ctx):
        raise RuntimeError("no such table")

    def fine(ctx):
        return {}, spark.createDataFrame([(1,)], "ingested long")

    plan = [
        Job("returns", fine, False, needs=("sales",)), Job("sales", fine, False, needs=("vendors", "items")),
        Job("revenue", fine, False, needs=("items", "absent")), Job("items", fine), Job("vendors", broken), Job("all", fine, False),
    ]
    result = run_jobs(RunContext(store, 1, T[0]), plan)
    assert {e for e, status in result.status.items() if status == "Success"} == {"items", "revenue"}
    assert result.errors["returns"] == "not loaded: sales failed" and result.errors["sales"] == "not loaded: vendors failed"
    assert rows(control.failed_jobs(store.read("job_log"), 1)) == [(1, 4)]


def test_hierarchy_load(spark, store, rows):
    df = spark.createDataFrame([(1, "top", "T", None), (2, "mid", "M", 1), (3, "low", "L", 2)], "id long, full_name string, name string, up long")
    ctx = RunContext(store, 1, T[0])
    tables = load_hierarchy(ctx, "subs", df, "id", "up", ["full_name"], {"parent_full_name": ("name", "full_name")})
    store.publish(1, tables)
    assert rows(store.read("subs_hierarchy").filter("id = 3")) == [
        (3, "low", 1, "T", 2, 2), (3, "low", 2, "M", 1, 2), (3, "low", 3, "low", 0, None),
    ]
    assert rows(store.read("subs_depth"), "id", "level") == [(1, None), (2, 1), (3, 2)]


def test_enriched_dimension(spark, rows):
    cols = "class_id long, name string, parent_id long"
    classes = spark.createDataFrame([(1, "top", None), (2, "sub", 1)], cols)
    out = enrich(CLASSES, classes, {"classes": classes})
    assert rows(out, "class_id", "parent_name") == [(1, "NA_GDW"), (2, "top")]


def test_a_dimension_load_enriches_and_seeds(spark, tmp_path, rows):
    store = RunStore(spark, str(tmp_path / "dw"))
    spec = DimSpec(name="classes", key="class_id", surrogate="class_key", scd1=("name", "parent_name"))
    cols = "class_id long, name string, parent_id long"
    for run, top in ((1, "top"), (2, "TOP")):
        classes = spark.createDataFrame([(1, top, None), (2, "sub", 1)], cols)
        ctx = RunContext(store, run, T[run])
        job = Job("classes", lambda c: load_dimension(c, spec, classes, tables={"classes": classes}, seed=True))
        assert run_jobs(ctx, [job]).errors == {}
    assert rows(store.read("classes"), "class_id", "name", "parent_name", "dw_active") == [
        (-99, "NA_GDW", "NA_GDW", "A"), (0, "NA_ERR", "NA_ERR", "A"), (1, "TOP", "NA_GDW", "A"), (2, "sub", "TOP", "A"),
    ]
    assert rows(store.read("classes").filter("class_id <= 0"), "class_key") == [(-99,), (0,)]


def test_specs_are_consistent():
    assert len(FACTS["po_fact"].lookups) == 17 and len(FACTS["vb_fact"].lookups) == 17
    assert len(FACTS["revenue_fact"].lookups) == 15 and len(FACTS["vra_fact"].lookups) == 12
    for spec in DIMENSIONS.values():
        targets = [spec.target(c) for c in spec.attributes]
        assert len(set(targets)) == len(targets) and spec.key not in spec.attributes


def test_stream_feeds_the_load(spark, tmp_path, rows):
    store = RunStore(spark, str(tmp_path / "dw"))
    run_jobs(RunContext(store, 0, T[0]), jobs(spark, FIRST_ITEMS, []), entities=["items"])
    source = str(tmp_path / "in")
    sales(spark, *FIRST_SALES).coalesce(1).write.parquet(source)
    seen = []

    def load(batch, run_id):
        seen.append(run_id)
        job = Job("sales", lambda ctx: load_fact(ctx, SALES, batch, {"items": store.read("items")}), False)
        assert run_jobs(RunContext(store, run_id, T[run_id]), [job]).errors == {}

    def drain():
        changes = incremental_extract(spark.readStream.schema(SALE_SCHEMA).parquet(source), "date_last_modified", "2000-01-01 00:00:00")
        feed = increment_feed(changes, load, str(tmp_path / "cp"), first_run_id=1).trigger(availableNow=True).start()
        feed.awaitTermination()

    drain()
    sales(spark, *SECOND_SALES).coalesce(1).write.mode("append").parquet(source)
    drain()
    assert seen == [1, 2]
    assert rows(store.read("sales"), "doc", "line", "amount", "dw_current") == [
        (10, 1, 5.0, 1), (10, 2, 6.0, 0), (10, 2, 9.0, 1), (12, 1, 8.0, 1),
    ]


def test_repeating_one_entity_keeps_the_others(spark, store, rows):
    run_jobs(RunContext(store, 1, T[0], subsidiary="27"), jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    before = store.published()
    again = RunContext(store, 1, T[0], attempt=2, subsidiary="27")
    result = run_jobs(again, jobs(spark, SECOND_ITEMS, FIRST_SALES, (T[0], T[1])), entities=["items"])
    assert result.status == {"items": "Success"}
    after = store.published()
    assert all(after[t] == before[t] for t in ("sales", "stage_sales", "sales_error"))
    assert rows(store.read("items").filter("item_id > 0"), "item_id", "label") == [(1, "one"), (2, "zwei"), (3, "three")]
    assert control.watermark_value(store.read("watermarks"), "sales", "27") == T[1]
    assert rows(store.read("job_log"), "runid", "entity") == [(1, "items"), (1, "sales")]
    assert store.read("message_log").filter("target_table = 'sales'").count() == 8

    run_jobs(RunContext(store, 2, T[1], subsidiary="27"), jobs(spark, SECOND_ITEMS, SECOND_SALES, (T[1], T[2])))
    with pytest.raises(LaterRunExists):
        run_jobs(RunContext(store, 1, T[0], attempt=3, subsidiary="27"), jobs(spark, FIRST_ITEMS, FIRST_SALES))


def test_compacted_facts_load_on(spark, store, rows):
    def state():
        return rows(store.read("sales"), "doc", "line", "amount", "dw_current")

    run_jobs(RunContext(store, 1, T[0], subsidiary="27"), jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    first, names = state(), {t: store.published()[t].keys() for t in ("sales", "stage_sales")}
    for table in names:
        assert compact(store, table, 1, 1, failed=0)
        assert store.published()[table].keys() == names[table]
    assert state() == first
    run_jobs(RunContext(store, 2, T[1], subsidiary="27"), jobs(spark, SECOND_ITEMS, SECOND_SALES, (T[1], T[2])))
    assert state() == [(10, 1, 5.0, 1), (10, 2, 6.0, 0), (10, 2, 9.0, 1), (12, 1, 8.0, 1), (13, 1, 1.0, 1)]
    third = [(10, 2, 2, 11.0, "LINE", T[2])]
    run_jobs(RunContext(store, 3, T[2], subsidiary="27"), jobs(spark, SECOND_ITEMS, third, (T[2], T[3])))
    before = state()
    assert compact(store, "sales", 1, 3, failed=0, prefix="closed/")
    assert {p for p in store.published()["sales"] if p.startswith("closed/")} == {"closed/10/runs2-3"} and state() == before


def test_statistics_of_parted_and_whole_tables(spark, store):
    run_jobs(RunContext(store, 1, T[0], subsidiary="27"), jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    for _ in range(2):
        names = register_and_analyze(store, {"sales": "stat_sales", "items": "stat_items"}, failed=0)
        assert names == ["stat_sales__0", "stat_sales__1", "stat_items"]
    assert spark.table("stat_sales").count() == 3
    told = spark.sql("DESCRIBE EXTENDED stat_sales__0").filter("col_name = 'Statistics'").first()[1]
    assert "2 rows" in told
    spark.sql("DROP VIEW stat_sales")
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_increments_follow_the_watermark(spark, store, rows):
    """Each run extracts from the last end on; repeating a run extracts the same again."""
    run_jobs(RunContext(store, 1, T[0], subsidiary="27"), jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    seen = []

    def source():
        seen.append(1)
        return sales(spark, *SECOND_SALES, (14, 1, 1, 2.0, "LINE", T[0]))

    job = increment_job(SALES, source, "date_last_modified", lambda ctx: {"items": ctx.before("items")}, T[2])
    for attempt in (1, 2):
        result = run_jobs(RunContext(store, 2, T[1], attempt, "27"), [job])
        assert result.errors == {} and len(seen) == attempt
        # the line of document 14 is older than the watermark, item 3 is not loaded yet
        assert rows(store.read("sales").filter("dw_current = 1"), "doc", "line", "amount") == [(10, 1, 5.0), (10, 2, 9.0), (12, 1, 8.0)]
        assert rows(store.read("watermarks"), "ext_start_dt", "ext_end_dt") == [(T[1], T[2])]


def test_a_missing_watermark_fails_the_fact_before_it_is_loaded(spark, store):
    ctx = RunContext(store, 1, T[0], subsidiary="99")
    result = run_jobs(ctx, jobs(spark, FIRST_ITEMS, FIRST_SALES, (T[0], T[1])))
    assert result.status == {"items": "Success", "sales": "Error"} and "no watermark for sales / 99" in result.errors["sales"]
    assert store.read("sales") is None


def test_rows_without_a_key_and_surplus_rows_are_counted(spark, store, rows):
    keyless = [(None, 1, 1, 5.0, "LINE", T[0]), (10, None, 2, 5.0, "LINE", T[0])]
    result = run_jobs(
        RunContext(store, 1, T[0], subsidiary="27"),
        jobs(spark, [*FIRST_ITEMS, (None, "none", "x")], [*FIRST_SALES, *keyless], (T[0], T[1])),
    )
    assert result.errors == {}
    assert rows(store.read("sales_rejected"), "runid", "doc", "line", "reason") == [(1, None, 1, "null key"), (1, 10, None, "null key")]
    assert rows(store.read("items_rejected"), "label") == [("none",)]
    notes = {(r["target_table"], r["message_stage"]): int(r["message_desc"].split()[-1]) for r in store.read("message_log").collect()}
    for entity, want in (("sales", (8, 2, 1, 5)), ("items", (4, 1, 0, 3))):
        assert tuple(notes[entity, k] for k in ("received", "null_keys", "duplicates", "ingested")) == want


def test_only_compared_columns_make_a_version(spark, tmp_path, rows):
    store, spec = RunStore(spark, str(tmp_path / "dw")), dataclasses.replace(SALES, compare=("doc", "line", "item_id", "amt", "line_type"))
    dims = {"items": spark.createDataFrame([(1, 101), (-99, -99)], "item_id long, item_key long")}
    for run, amount in ((1, 5.0), (2, 5.0), (3, 6.0)):
        ctx = RunContext(store, run, T[run])
        result = run_jobs(ctx, [Job("sales", lambda c: load_fact(c, spec, sales(spark, (10, 1, 1, amount, "LINE", T[run])), dims), False)])
        assert result.errors == {}
    notes = store.read("message_log").filter("message_stage = 'updated'")
    assert rows(notes, "runid", "message_desc") == [(r, f"no of records updated --> {n}") for r, n in ((1, 0), (2, 0), (3, 1))]
    with pytest.raises(ValueError, match="lacks compared columns"):
        spec.compared(["doc", "line"])


def test_an_extract_without_a_column_is_refused(spark):
    from lodestar.plans.documents import po_extract

    tables = {"transactions": spark.createDataFrame([(1, "Purchase Order")], "transaction_id long, transaction_type string")}
    with pytest.raises(ValueError, match="transactions lacks the columns .*due_date"):
        po_extract(tables, 27, T[0])
