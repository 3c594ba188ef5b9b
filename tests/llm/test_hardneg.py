"""Hard negatives against brute force, and what the threshold saves."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import hardneg
from lodestar.llm.hardneg import SortedLists, hard_negatives

SCHEMA = "vec_id long, label int, vector array<float>, ask long, dim string, slot double, of string, anchor string"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=10, k=5, share=80):
    ok = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, v in ok:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in ok if j != i and len(w) == len(v)))
        for s, p, _ in [t for t in scored if t[2] == y][:k]:
            near = [t for t in scored if t[2] != y and share * -s <= 100 * -t[0] <= 100 * -s]
            out += [(i, p, r + 1, t[1], -s, -t[0]) for r, t in enumerate(near[:k])]
    return sorted(out)


def run(spark, rows, every=10):
    table = spark.createDataFrame([(*r, 1, "x", 0.5, "y", "z") for r in rows], SCHEMA)
    return sorted(tuple(r[c] for c in COLUMNS) for r in hard_negatives(table, F.col("vec_id") % every == 0).collect())


def made(n, dim, labels, seed=0, near=0.0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=dim)
    x = rng.normal(size=(n, dim)) * (1 - near) + base * near
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(k, int(rng.integers(labels)), [float(v) for v in x[k].astype(np.float32)]) for k in range(n)]


@pytest.mark.parametrize(("shard", "labels", "near"), [(4096, 4, 0.0), (60, 4, 0.3), (60, 2, 0.9), (40, 30, 0.5), (16, 1, 0.5)])
def test_against_brute_force(spark, monkeypatch, shard, labels, near):
    monkeypatch.setattr(hardneg, "LEAST_SHARD", shard)
    monkeypatch.setattr(hardneg, "SHARD_SCALE", 1)
    rows = made(400, 6, labels, near=near)
    assert run(spark, rows) == brute(rows)


def test_cases(spark):
    ties = [(k, k % 3, [0.5, -0.25]) for k in range(30)]
    odd = [
        (100, None, [0.5, 0.5]), (101, 1, None), (102, 1, [0.5, None]), (103, 1, [float("nan"), 0.1]), (104, 1, [float("inf"), 0.1]),
        (None, 1, [0.5, 0.5]), (110, 1, []), (111, 2, []), (121, 1, []), (120, 1, [0.1, 0.2, 0.3]), (130, 1, [0.0, 0.0]), (131, 1, [-0.5, 0.25]),
        (140, 7, [-3.0, 1.0]), (141, 7, [3.0, -1.0]),
    ]
    assert run(spark, ties + odd) == brute(ties + odd)
    assert run(spark, ties + ties) == brute(ties + ties)
    assert run(spark, []) == []


def test_large_components_are_exact(spark):
    rows = [(k, k % 2, [float(np.float32(2.0**19 + 977 * k)), float(np.float32(-(2.0**18) - 31 * k)), 2.0**21]) for k in range(60)]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_the_long_range_end_there():
    lists = SortedLists(np.array([1, 2]), np.array([0, 0]), np.array([[2.0**62], [2.0**61]]))
    ids, scores = lists.search(9, np.array([2.0**62]), 0, True, [(None, None)], 5)[0]
    assert ids.tolist() == [1, 2] and scores.tolist() == [2**63 - 1] * 2


def test_threshold_ends_the_search(monkeypatch):
    rng = np.random.default_rng(1)
    rows = np.floor(256 * rng.normal(size=(20_000, 3)))
    lists = SortedLists(np.arange(20_000), np.zeros(20_000, np.int64), rows)
    met = 0
    score = SortedLists._scores

    def counted(self, at, anchor, exact):
        nonlocal met
        met += len(at)
        return score(self, at, anchor, exact)

    monkeypatch.setattr(SortedLists, "_scores", counted)
    for q in range(20):
        anchor = rows[q]
        ids, scores = lists.search(q, anchor, 0, True, [(None, None)], 5)[0]
        every = rows @ anchor
        order = [i for i in np.lexsort((np.arange(20_000), -every)) if i != q][:5]
        assert ids.tolist() == order and scores.tolist() == every[order].tolist()
    assert met < 20 * 20_000 / 4
