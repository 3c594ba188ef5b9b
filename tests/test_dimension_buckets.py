"""Dimensions kept in buckets: only touched ones are read and rewritten."""

from __future__ import annotations

import dataclasses
import os
from pathlib import Path

import pytest

from lodestar.operators.scd import DimSpec
from lodestar.plans.load import RunContext, load_dimension, replay_dimension
from lodestar.sources.extract_files import latest_file
from lodestar.sources.run_store import RunStore

WHOLE = DimSpec(name="items", key="item_id", surrogate="item_key", scd1=("label",), scd2=("kind",))
SPEC = dataclasses.replace(WHOLE, buckets=8)
TS = [f"2026-01-0{d} 00:00:00" for d in range(1, 6)]


def image(spark, rows):
    return spark.createDataFrame(rows, "item_id long, label string, kind string")


def load(store, run, spec, rows, **options):
    ctx = RunContext(store, run, TS[run - 1])
    source = f"{store.root}/source{run}"
    image(store.spark, rows).write.mode("overwrite").parquet(source)
    written, counts = load_dimension(ctx, spec, store.spark.read.parquet(source), **options)
    store.publish(run, written)
    return counts.first().asDict()


def versions(store):
    return sorted(tuple(r) for r in store.read("items").drop("item_key").collect())


IMAGES = [
    [(i, f"a{i}", "x") for i in range(100)],
    [(i, f"a{i}" if i != 7 else "changed", "y" if i == 8 else "x") for i in range(100) if i != 9] + [(200, "new", None)],
    [(i, f"a{i}", "x") for i in range(100)],
    [],
]


@pytest.mark.parametrize("seed", [False, True])
def test_equals_the_dimension_kept_whole(spark, tmp_path, seed):
    whole, parts = RunStore(spark, str(tmp_path / "whole")), RunStore(spark, str(tmp_path / "parts"))
    for run, rows in enumerate(IMAGES, 1):
        a, b = (load(store, run, spec, rows, seed=seed) for store, spec in ((whole, WHOLE), (parts, SPEC)))
        assert a == b and versions(whole) == versions(parts)
        keys = [r["item_key"] for r in parts.read("items").collect()]
        assert len(set(keys)) == len(keys)
        if rows:
            a, b = (sorted(map(repr, store.read("stage_items").collect())) for store in (whole, parts))
            assert a == b
    assert parts.published().get("stage_items", {}) == {}


def test_untouched_parts_are_neither_read_nor_written(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    load(store, 1, SPEC, IMAGES[0])
    before = store.published()["items"]
    assert len(before) == 8
    moved = spark.createDataFrame([(7,), (8,), (9,), (200,)], "item_id long").select(SPEC.part()).distinct()
    touched = {r[0] for r in moved.collect()}
    assert 0 < len(touched) < 8
    for part, path in before.items():
        if part not in touched:
            for file in Path(path.removeprefix("file:")).glob("*.parquet"):
                file.write_bytes(b"unreadable")
    load(store, 2, SPEC, IMAGES[1])
    after = store.published()["items"]
    assert {p for p in after if after[p] != before.get(p)} == touched
    assert {p.name.removeprefix("dw_part=") for p in (tmp_path / "items/run2/attempt1").glob("dw_part=*")} == touched


def test_nothing_moved_keeps_every_part(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    load(store, 1, SPEC, IMAGES[0])
    before = store.published()
    load(store, 2, SPEC, IMAGES[0])
    assert store.published()["items"] == before["items"] and store.published()["stage_items"] == before["stage_items"]


def test_refusals(spark, tmp_path):
    with pytest.raises(ValueError, match="does not divide"):
        dataclasses.replace(WHOLE, buckets=7)
    store = RunStore(spark, str(tmp_path))
    load(store, 1, SPEC, IMAGES[0])
    for other in (WHOLE, dataclasses.replace(WHOLE, buckets=16)):
        with pytest.raises(ValueError, match="kept in other parts"):
            load(store, 2, other, IMAGES[0])
    with pytest.raises(ValueError, match="cannot be replayed"):
        replay_dimension(RunContext(store, 3, TS[2]), SPEC, [RunContext(store, 1, TS[0])], image(spark, IMAGES[0]))


def test_latest_file(spark, tmp_path):
    for name, time in (("in/b_1.csv", 100), ("in/b_2.csv", 50), ("in/a_9.csv", 300), ("in/b_0.csv", 100), ("in/b_old/c.csv", 20)):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("x")
        os.utime(file, (time, time))
    assert latest_file(spark, f"{tmp_path}/in", "b_").endswith("/in/b_1.csv")
    assert latest_file(spark, f"{tmp_path}/in").endswith("/in/a_9.csv")
    assert latest_file(spark, str(tmp_path), "in/b_o").endswith("/in/b_old/c.csv")
    assert latest_file(spark, f"{tmp_path}/in", "none") is None
