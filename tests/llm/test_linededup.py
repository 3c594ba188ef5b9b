"""Line removal against a plain loop."""

from __future__ import annotations

import random

import pytest

from lodestar.llm.linededup import dedup_lines

SCHEMA = "doc_id long, text string, gone string, row_a int, others string, n_lines string, `key.a` int, pos double"
SPACE = " \t\n\v\f\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_chars=20, min_docs=3):
    docs = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                docs.setdefault(key_of(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            own = docs.get(key_of(line), set())
            if len(key_of(line)) < min_chars or len(own) < min_docs or i == max(own):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "g", 1, "o", "old", 3, 1.5) for r in rows], SCHEMA)
    out = dedup_lines(docs, **kw)
    assert out.columns == [*docs.columns, "n_dropped"]
    got = out.collect()
    assert all((r["gone"], r["row_a"], r["others"], r["key.a"], r["pos"]) == ("g", 1, "o", 3, 1.5) for r in got)
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got), key=repr)


COMMON = "  This Line stands in Many documents\t"
CASES = [
    (1, COMMON + "\nown\n\n"),
    (2, "first\n" + COMMON.upper()),
    (3, COMMON + "\n" + COMMON),
    (9, "\n" + COMMON.lower() + "\r\nend"),
    (4, None),
    (5, ""),
    (6, "x" * 19 + "\n" + "é" * 20),
    (7, "x" * 19 + "\n" + "é" * 20),
    (8, "x" * 19 + "\n" + "é" * 20 + " "),
    (None, COMMON + "\nnull id"),
    (None, None),
    (3, COMMON + "\nanother text of the same id"),
    (9, "\n" + COMMON.lower() + "\r\nend"),
    (11, "only in two documents of all\n" * 50_000),
    (12, "only in two documents of all"),
    (13, "within one document many times\n" * 40),
]


@pytest.mark.parametrize("kw", [{}, {"min_chars": 1, "min_docs": 2}])
def test_cases(spark, kw):
    assert run(spark, CASES, **kw) == brute(CASES, **kw)


def test_random_lines(spark):
    rng = random.Random(5)
    pool = [f"{'Line ' * rng.randint(1, 9)}{k % 40}" for k in range(90)]
    rows = [(rng.randint(0, 70), "\n".join(rng.choices(pool, k=rng.randint(0, 30)))) for _ in range(120)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
