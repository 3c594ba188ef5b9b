"""Every driver query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import importlib
import os
import sys

import pytest

import __spark_entry__
from __spark_entry__ import entry
from lodestar.workload.oracle import ORACLE
from lodestar.workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([row[i] for i in order]) for row in data)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    out = QUERIES[name](spark, FOLDER)
    cursor = sql.execute(ORACLE[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert canonical(out.columns, [tuple(r) for r in out.collect()]) == want


def test_entry(spark):
    assert not entry(spark).isEmpty()


def test_entry_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    reduced = importlib.reload(__spark_entry__)
    assert reduced.queries().keys() == QUERIES.keys() and reduced.oracle_sql().keys() == ORACLE.keys()
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
