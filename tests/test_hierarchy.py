from __future__ import annotations

import random

import pytest

from lodestar.operators.hierarchy import (
    changed_nodes,
    hierarchy_closure,
    hierarchy_closure_update,
    hierarchy_depth,
    hierarchy_tables,
    parent_lookup,
)

# 1 and 6 are roots; 8 and 9 point at each other, 10 hangs off them; 11 is an orphan and 12 below it.
EDGES = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, None), (7, 6), (8, 9), (9, 8), (10, 9), (11, 99), (12, 11), (13, 13)]


def expected(edges):
    parent = dict(edges)
    depth, paths = {}, {}
    for node in parent:
        path, at, seen = [], node, set()
        while at in parent and parent[at] is not None and at not in seen:
            seen.add(at)
            at = parent[at]
            path.append(at)
        if at in parent and parent[at] is None:
            depth[node], paths[node] = len(path), path
    closure = [(n, n, 0, None) for n in paths]
    for n, path in paths.items():
        closure += [(n, a, i, 0 if depth[n] == 1 else depth[n]) for i, a in enumerate(path, 1)]
    return depth, sorted(closure, key=lambda r: r[:3])


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame([(k, f"n{k}", p) for k, p in EDGES], "id long, name string, up long")
    edges = parent_lookup(df, "id", "up", {"up_name": "name"})
    depth, closure = expected(EDGES)
    got = {r["id"]: r["level"] for r in hierarchy_depth(edges, "id", "up").collect()}
    assert got == {n: (d or None) for n, d in depth.items()}
    out = hierarchy_closure(edges, "id", "up", {"up_name": "name"})
    assert rows(out, "id", "up", "level", "q_level") == closure
    assert out.filter("up_name != concat('n', up)").isEmpty()
    depths, both = hierarchy_tables(edges, "id", "up", {"up_name": "name"})
    assert {r["id"]: r["level"] for r in depths.collect()} == got and both.exceptAll(out).isEmpty() and out.exceptAll(both).isEmpty()
    assert len(closure) == sum(depth.values()) + len(depth)


@pytest.mark.parametrize("seed", range(3))
def test_update_equals_the_whole_climb(spark, rows, seed):
    rng = random.Random(seed)
    ids = range(1, 41)
    old = {i: None if rng.random() < 0.1 else rng.randrange(1, 46) if rng.random() < 0.1 else rng.randrange(0, i) for i in ids}
    new = {i: p for i, p in old.items() if rng.random() > 0.05}
    new |= {i: rng.choice([None, *range(1, 48)]) for i in rng.sample(ids, 4)} | {50: 3, 51: 50, 43: 1}
    states = []
    for state, stamp in ((old, "n"), (new, "m")):
        named = [(i, f"{stamp if i % 9 == 0 else 'n'}{i}", p) for i, p in state.items()]
        states.append(parent_lookup(spark.createDataFrame(named, "id long, name string, up long"), "id", "up", {"up_name": "name"}))
    before, after = states
    attrs = {"up_name": "name"}
    changed = changed_nodes(before, after, "id")
    assert 0 < changed.count() < 40
    got = hierarchy_closure_update(hierarchy_closure(before, "id", "up", attrs), after, changed, "id", "up", attrs)
    whole = hierarchy_closure(after, "id", "up", attrs)
    assert got.columns == whole.columns
    assert rows(got, "id", "up", "level", "q_level") == expected(list(new.items()))[1]
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_update_without_changes(spark, rows):
    edges = spark.createDataFrame(EDGES, "id long, up long")
    closure = hierarchy_closure(edges, "id", "up")
    nothing = changed_nodes(edges, edges, "id")
    assert nothing.isEmpty()
    assert rows(hierarchy_closure_update(closure, edges, nothing, "id", "up"), "id", "up", "level", "q_level") == expected(EDGES)[1]


def test_root_level(spark):
    df = spark.createDataFrame(EDGES, "id long, up long")
    assert {r["level"] for r in hierarchy_depth(df, "id", "up", 0).filter("up is null").collect()} == {0}


def test_long_chain_and_hot_parent(spark):
    chain = [(0, None)] + [(i, i - 1) for i in range(1, 70)]
    star = [(1000 + i, 3) for i in range(200)]
    df = spark.createDataFrame(chain + star, "id long, up long")
    depth, closure = expected(chain + star)
    out = hierarchy_closure(df, "id", "up")
    assert sorted((tuple(r) for r in out.select("id", "up", "level", "q_level").collect()), key=lambda r: r[:3]) == closure


def test_nothing_reaches_a_root(spark):
    df = spark.createDataFrame([(1, 2), (2, 1)], "id long, up long")
    assert hierarchy_closure(df, "id", "up").isEmpty()
