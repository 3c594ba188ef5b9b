"""What the loads of facts write and shuffle."""

from __future__ import annotations

import datetime as dt
import glob
import os
import time

import pyarrow.parquet as pq
import pytest

from lodestar.plans import load
from lodestar.plans.facts import FactSpec, LookupSpec
from lodestar.plans.load import RunContext, load_fact, replay_fact
from lodestar.session import cut_lineage, shuffles_dropped
from lodestar.sources.run_store import RunStore
from lodestar.workload import fixtures

SPEC = FactSpec(
    name="sales",
    key=("doc", "line"),
    lookups=(LookupSpec("item_key", "items", "item_id", "item_id", "item_key"),),
    line_types=("LINE",),
    part_width=1000,
)
SCHEMA = "doc long, line int, item_id long, line_type string, date_last_modified timestamp_ntz"


@pytest.fixture
def runs(spark, tmp_path):
    """Two runs, and the first one replayed; the second increment changes the lines of every third document."""
    store = RunStore(spark, str(tmp_path / "dw"))
    dims = {"items": spark.createDataFrame([(k, k + 100) for k in range(5)], "item_id long, item_key long")}

    def increment(run):
        last = {d: run if d % 3 == 0 else 0 for d in range(199, -1, -1)}
        rows = [(d, n, (d + k) % 6, "LINE", dt.datetime(2026, 1, 1 + k)) for d, k in last.items() for n in (2, 1)]
        return spark.createDataFrame(rows + rows[:7], SCHEMA)

    contexts = [RunContext(store, k, dt.datetime(2026, 2, k)) for k in (1, 2, 3)]
    for k, ctx in enumerate(contexts[:2], 1):
        ctx.store.publish(k, load_fact(ctx, SPEC, increment(k), dims)[0])
    written, _ = replay_fact(contexts[2], SPEC, contexts[:2], increment(1), lambda run: dims)
    store.publish(3, written)
    return store


def test_increment_and_resolved_rows_are_not_dealt_again(runs, rows):
    """The latest images were written and shuffled to the stage anew, resolved rows were shuffled into two folders."""
    assert not os.path.exists(f"{runs.root}/prestage_sales")
    resolved = glob.glob(f"{runs.root}/resolved_sales/**/part-*", recursive=True)
    assert resolved and not any("rejected=" in f for f in resolved)
    want = [(d, n, (d + 2 * (d % 3 == 0)) % 6) for d in range(200) for n in (1, 2)]
    current = runs.read("sales").filter("dw_current = 1")
    assert rows(current, "doc", "line", "item_id") == [r for r in want if r[2] < 5]
    assert rows(runs.read("stage_sales"), "doc", "line", "item_id") == want
    closed = [r for r in ((d, n, (d + (d % 3 == 0)) % 6) for d in range(0, 200, 3) for n in (1, 2)) if r[2] < 5]
    assert rows(runs.read("sales").filter("dw_current = 0"), "doc", "line", "item_id") == closed


def test_tables_are_written_in_zstd(runs):
    for table in ("received_sales", "sales", "stage_sales"):
        files = glob.glob(f"{runs.root}/{table}/**/part-*.parquet", recursive=True)
        assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)


def test_lines_are_dealt_once_for_latest_image_and_header(spark, tmp_path, monkeypatch, rows):
    day = dt.datetime(1998, 1, 1)
    lines = [(o, n, 1, 1, q, 1.0, 0.1, 0.1, "R", "F", day) for o in (1, 2, 4) for n in (1, 2) for q in (3.0, 2.0)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
    columns += "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, 7, day) for o in (1, 2, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(fixtures, "cut_lineage", lambda df: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = fixtures.Source(spark, str(tmp_path)).fact_lines
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(found, "l_orderkey", "l_linenumber", "l_quantity") == sorted((o, n, 3.0) for o in (1, 2, 2) for n in (1, 2))


def test_stage_says_what_became_of_a_line(runs, rows):
    """New and changed lines had a table of their own, which met the stage again."""
    assert not os.path.exists(f"{runs.root}/delta_sales")
    stage = runs.read("stage_sales", 3)
    assert rows(stage.groupBy("dw_op").count()) == [("nochange", 266), ("update", 134)]


def test_resolved_rows_are_kept_for_the_last_load_only(runs, rows, spark):
    """Those of every load stayed next to the fact and the errors that had taken them over."""
    folders = {os.path.dirname(f) for f in glob.glob(f"{runs.root}/resolved_sales/**/part-*", recursive=True)}
    assert len(folders) == 1
    assert rows(spark.read.parquet(*folders), "doc", "line") == [(d, n) for d in range(0, 200, 3) for n in (1, 2)]
    unknown = [(d, n) for k, step in ((1, 1), (2, 3)) for d in range(0, 200, step) for n in (1, 2) if (d + k * (d % 3 == 0)) % 6 == 5]
    assert rows(runs.read("sales_error"), "doc", "line") == sorted(unknown)


def test_later_runs_of_a_replay_take_their_increment_from_where_it_lies(runs):
    parts = runs.published()["received_sales"]
    assert parts["run2"] == runs.path("received_sales", 2)
    assert runs.read("received_sales").count() == 814


@pytest.mark.parametrize("broadcasts", ["10MB", "-1"])
def test_parts_are_written_in_few_files(spark, tmp_path, rows, monkeypatch, broadcasts):
    """With lookups that are broadcast and with lookups that shuffle the lines; several numbers a part."""
    monkeypatch.setattr(load, "DEAL_ROWS", 60)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        store = RunStore(spark, str(tmp_path / "dw"))
        spec = FactSpec("sales", SPEC.lookups, SPEC.line_types, key=SPEC.key, part_width=50)
        spark.range(5).selectExpr("id item_id", "id + 100 item_key").write.parquet(f"{tmp_path}/items")
        dims = {"items": spark.read.parquet(f"{tmp_path}/items")}
        for run in (1, 2):
            lines = [(d, n, (d + run * (d % 3 == 0)) % 6, "LINE", dt.datetime(2026, 1, run if d % 3 == 0 else 1)) for d in range(1000) for n in (1, 2)]
            ctx = RunContext(store, run, dt.datetime(2026, 2, run))
            store.publish(run, load_fact(ctx, spec, spark.createDataFrame(lines, SCHEMA).repartition(8), dims)[0])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [(d, n, (d + 2 * (d % 3 == 0)) % 6) for d in range(1000) for n in (1, 2)]
    assert rows(store.read("stage_sales"), "doc", "line", "item_id") == want
    fact = store.read("sales")
    assert rows(fact.filter("dw_current = 1"), "doc", "line", "item_id") == [r for r in want if r[2] < 5]
    old = [(d, n, (d + 1) % 6) for d in range(0, 1000, 3) for n in (1, 2)]
    assert rows(fact.filter("dw_current = 0"), "doc", "line", "item_id") == [r for r in old if r[2] < 5]
    for table in ("stage_sales", "sales"):
        folders = glob.glob(f"{store.root}/{table}/**/dw_part=*", recursive=True)
        assert folders and all(len(glob.glob(f"{f}/part-*")) <= 8 for f in folders)


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def test_shuffles_of_a_written_table_leave_the_disk(spark, tmp_path, rows):
    """Those of all writes of a load stayed until the driver collected its garbage."""
    dealt = spark.range(1000).selectExpr("id % 10 k").groupBy("k").count()
    for write in (cut_lineage, lambda df: RunStore(spark, str(tmp_path / "dw")).write(df, "sales", 1)):
        known = _shuffle_files(spark)
        assert rows(write(dealt)) == [(k, 100) for k in range(10)]
        until = time.time() + 20
        while _shuffle_files(spark) - known and time.time() < until:
            time.sleep(0.1)
        assert not _shuffle_files(spark) - known
        assert rows(dealt) == [(k, 100) for k in range(10)]


def test_the_setting_that_drops_shuffles_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    for value in ("false", "true"):
        spark.conf.set(name, value)
        with pytest.raises(RuntimeError), shuffles_dropped(spark):
            assert spark.conf.get(name) == "true"
            raise RuntimeError
        assert spark.conf.get(name) == value
    spark.conf.unset(name)
    assert spark.conf.get(name) == before
