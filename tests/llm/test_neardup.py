"""Near duplicates against brute force."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm.components import connected_components
from lodestar.llm.neardup import near_duplicates
from lodestar.llm.superminhash import signatures
from lodestar.llm.words import mix

SCHEMA = "doc_id long, text string, lang string, n_shingles long"


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def made_rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows, at = [], 0
    for group in range(12):
        base = list(rng.choice(words, rng.integers(40, 200)))
        for _ in range(rng.integers(1, 9)):
            copy = list(base)
            for k in rng.integers(0, len(base), rng.integers(0, 9)):
                copy[k] = "X" + str(rng.integers(1000))
            rows.append((at, " ".join(copy)))
            at += 3
    return rows


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_against_brute_force(spark, rows, n, percent):
    data = made_rows() + [(900, None), (901, ""), (902, "one two"), (903, "One\ttwo"), (904, " \n "), (905, "two one")]
    frame = spark.createDataFrame([(i, t, "en", -1) for i, t in data], SCHEMA)
    out = near_duplicates(frame, n, percent, block=4)
    assert rows(out, "doc_id", "n_shingles", "component_id", "kept") == brute(data, n, percent)


def test_chain_of_copies_is_one_component(spark, rows):
    """Neighbours of the chain are linked, its ends are not."""
    words = [f"a{i}" for i in range(120)]
    data = []
    for k in range(12):
        copy = list(words)
        for j in range(k):
            copy[j * 9] = f"z{j}"
        data.append((50 - k, " ".join(copy)))
    frame = spark.createDataFrame([(i, t, None, None) for i, t in data], SCHEMA)
    out = near_duplicates(frame, 3, 85, block=3)
    assert rows(out, "doc_id", "n_shingles", "component_id", "kept") == brute(data, 3, 85)


def test_odd_rows(spark):
    data = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "a b c d e f"), (7, "x " * 50_000)]
    out = near_duplicates(spark.createDataFrame([(i, t, None, 5) for i, t in data], SCHEMA))
    got = sorted(map(tuple, out.collect()), key=repr)
    want = [(1, 2, 1, True)] * 2 + [(None, 2, None, True), (None, 0, None, True), (2, 2, 1, False), (7, 1, 7, True)]
    assert got == sorted(want, key=repr)
    empty = near_duplicates(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.isEmpty()


def test_documents_against_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = near_duplicates(docs, 3, 85)
    assert rows(out, "doc_id", "n_shingles", "component_id", "kept") == brute(data, 3, 85)


def sequential_superminhash(elements, m):
    """The algorithm one element at a time, with its early stop."""
    h, q, p = [1 << 63] * m, [-1] * m, [0] * m
    for i, d in enumerate(elements):
        for j in range(m):
            if j << 32 > max(h):
                break
            x = int(mix(np.array([(int(d) + 0x9E3779B97F4A7C15 * (j + 1)) % (1 << 64)], np.uint64))[0])
            k = j + (((x & 0xFFFFFFFF) * (m - j)) >> 32)
            for s in (j, k):
                if q[s] != i:
                    q[s], p[s] = i, s
            p[j], p[k] = p[k], p[j]
            h[p[j]] = min(h[p[j]], (j << 32) | (x >> 32))
    return h


def test_signature_equals_the_sequential_algorithm():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 2, 7, 40, 900)]
    rows = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = signatures(np.concatenate(sets), rows, 48)
    for s, row in zip(sets, got):
        assert [int(v) for v in row] == sequential_superminhash(s, 48)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    other = np.concatenate([base[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    a, b = signatures(np.concatenate([base, other]), np.array([0, 1000, 2000]), 512)
    assert abs((a == b).mean() - 800 / 1200) < 0.07


def test_components(spark, rows):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    frame = spark.createDataFrame(links + [(None, 3), (7, 7)], "a long, b long")
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    assert rows(connected_components(frame.repartition(5)), "id", "component") == sorted((x, find(x)) for x in up)
    assert connected_components(frame.limit(0)).isEmpty()


def test_blocks_bounded_by_shingles_lose_no_link(spark):
    rows = made_rows()
    docs = spark.createDataFrame([(i, t, "en", 0) for i, t in rows], SCHEMA)
    got = near_duplicates(docs, 3, 85, block=1000, block_shingles=150).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 85)
