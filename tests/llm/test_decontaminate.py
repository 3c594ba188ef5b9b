"""Benchmark windows against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest

from lodestar.llm.decontaminate import contamination, decontaminate

SCHEMA = "doc_id long, text string, spans int, matches string, n_words string"


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench, window):
    out = []
    items = [(i, words(t)) for i, t in bench]
    for d, text in docs:
        ws, hit, longest = words(text), set(), {}
        for i, b in items:
            n = min(window, len(b))
            inside = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
            for p in range(len(ws) - n + 1) if n else ():
                if tuple(ws[p : p + n]) in inside:
                    hit |= set(range(p, p + n))
                    best = n
                    for k in range(len(b) - n + 1):
                        m = 0
                        while p + m < len(ws) and k + m < len(b) and ws[p + m] == b[k + m]:
                            m += 1
                        best = max(best, m)
                    longest[i] = max(longest.get(i, 0), best)
        out.append((d, len(ws), len(hit), sorted(i for i in longest if i is not None), bool(hit), longest))
    return out


def collected(out):
    rows = []
    for r in out.collect():
        longest = {}
        for m in r["matches"]:
            longest[m["item_id"]] = max(longest.get(m["item_id"], 0), m["n_words"])
        rows.append((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"], longest))
    return rows


def key(r):
    return (r[0] is not None, r[0] or 0, r[1])


def made():
    rng = np.random.default_rng(11)
    vocabulary = [f"v{i}" for i in range(60)]
    bench = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 30)))) for i in range(40)]
    bench += [(3, bench[3][1]), (90, bench[4][1]), (91, None), (92, "  ,"), (None, bench[5][1]), (93, "Ünder-9")]
    docs = []
    for d in range(60):
        text = list(rng.choice(vocabulary, rng.integers(0, 60)))
        for _ in range(rng.integers(0, 3)):
            b = words(bench[rng.integers(0, 40)][1])
            at = rng.integers(0, len(text) + 1)
            text[at:at] = b[rng.integers(0, max(1, len(b) - 9)) :]
        docs.append((d, " ".join(w.upper() if rng.random() < 0.3 else w for w in text)))
    docs += [(1, docs[1][1]), (100, None), (101, ""), (None, docs[2][1]), (102, "ünder 9, Ünder"), (103, "v1 " * 30_000)]
    return docs, bench


@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_against_brute_force(spark, block_bytes):
    docs, bench = made()
    frame = spark.createDataFrame([(d, t, 1, "x", None) for d, t in docs], SCHEMA)
    out = contamination(frame, spark.createDataFrame(bench, "item_id long, text string"), 10, block_bytes)
    want = brute(docs, bench, 10)
    assert sorted(collected(out), key=key) == sorted(want, key=key)
    clean = decontaminate(frame, spark.createDataFrame(bench, "item_id long, text string"), 10, block_bytes)
    assert clean.columns == frame.columns
    assert sorted(r["doc_id"] for r in clean.collect() if r["doc_id"] is not None) == sorted(w[0] for w in want if not w[4] and w[0] is not None)


def test_empty_tables(spark):
    docs, bench = made()
    frame = spark.createDataFrame([(d, t, 1, "x", None) for d, t in docs], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    out = collected(contamination(frame, none))
    assert sorted(out, key=key) == sorted(brute(docs, [], 10), key=key)
    assert decontaminate(frame, none).count() == len(docs)
    assert contamination(frame.limit(0), spark.createDataFrame(bench, "item_id long, text string")).isEmpty()


def test_words_of_long_matches_are_placed(spark):
    bench = [(5, " ".join(f"b{i}" for i in range(25)))]
    docs = [(1, "x y " + " ".join(f"b{i}" for i in range(4, 25)) + " z")]
    out = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert out.first()["matches"] == [(5, 2, 4, 21)] and out.first()["n_hit"] == 21
