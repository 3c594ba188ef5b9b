"""Graph search against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from lodestar.llm import ann
from lodestar.llm.ann import build_graph, build_index, robust_prune, search_index
from lodestar.llm.queries import QUERIES

SCHEMA = "vec_id long, vector array<float>"


def exact(rows, asked, k):
    """All neighbours in double precision; equal scores by id."""
    clean = {(i, tuple(np.float32(v).tolist())) for i, v in rows}
    out = {}
    for q, x in {(i, tuple(np.float32(v).tolist())) for i, v in asked}:
        x = np.array(x, np.float64)
        scored = []
        for i, v in clean:
            v = np.array(v, np.float64)
            if i != q and len(v) == len(x):
                scored.append((-float(v @ x / np.sqrt((v @ v) * (x @ x))), i))
        out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scored)[:k]]
    return out


def collected(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 12))
    rows = [(i, base[i % 400].tolist()) for i in range(460)]  # copies
    rows += [(500 + i, (base[i] * 2).tolist()) for i in range(5)]  # equal cosines of other vectors
    rows += [(600 + i, base[7].tolist()) for i in range(40)] + [(3, base[3].tolist())]
    return rows


@pytest.mark.parametrize("scale", [ann.SHARD_SCALE, 4])
def test_small_tables_are_exact(spark, made, monkeypatch, scale):
    monkeypatch.setattr(ann, "SHARD_SCALE", scale)
    odd = [(700, None), (701, []), (702, [0.0] * 12), (703, [None] * 12), (704, [float("nan")] * 12), (705, [float("inf")] * 12),
           (None, [1.0] * 12), (706, [1.0, 2.0]), (707, [2.0, 1.0])]
    frame = spark.createDataFrame(made + odd, SCHEMA)
    asked = [r for r in made if r[0] % 10 == 0] + [(706, [1.0, 2.0])]
    queries = spark.createDataFrame(asked + odd[:7], "query_id long, query array<float>")
    got, want = collected(search_index(build_index(frame, 5), queries, 5)), exact(made + odd[7:], asked, 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-9)
    same = sum([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
    assert same >= 0.95 * len(want)  # cosines of scaled copies may differ in the last bit
    assert got[706] == [(707, pytest.approx(0.8))]


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    queries = spark.createDataFrame([(1, [1.0])], "query_id long, query array<float>")
    assert search_index(build_index(frame, 5), queries, 5).isEmpty()
    one = spark.createDataFrame([(1, [1.0])], SCHEMA)
    assert search_index(build_index(one, 5), queries, 5).isEmpty()


def test_pruning_keeps_diverse_edges():
    """Of two near points in one direction one is kept, and the farther one elsewhere."""
    unit = np.array([[1, 0], [0.99, 0.14], [0.98, 0.2], [0.9, -0.43]], np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    dist = (2 - 2 * unit[1:] @ unit[0])[None, :]
    kept = robust_prune(unit, np.array([0]), np.array([[1, 2, 3]]), dist, 1.2, 3)
    assert kept.tolist() == [[1, 3, -1]]


def test_graph_reaches_every_node():
    unit = np.random.default_rng(1).normal(size=(700, 8)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links, entry = build_graph(unit)
    seen, todo = {entry}, [entry]
    while todo:
        for v in links[todo.pop()].tolist():
            if v >= 0 and v not in seen:
                seen.add(v)
                todo.append(v)
    assert len(seen) >= 695 and (links != np.arange(700)[:, None]).all()


def test_recall_on_the_embeddings(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = collected(QUERIES["op2_nearest_vectors"](spark, "/root/testdata/sf0.1"))
    want = exact(rows, [r for r in rows if r[0] % 50 == 0], 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.95 * sum(len(w) for w in want.values())
