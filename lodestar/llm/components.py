"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestar.llm.common import cut_lineage


class UnionFind:
    """Union by the smaller label, with path halving."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links becomes stars around the least id of its groups."""
    for batch in batches:
        groups = UnionFind()
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            groups.union(a, b)
        pairs = [(x, groups.find(x)) for x in groups.up]
        pairs = [(x, r) for x, r in pairs if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``links`` (long columns ``a``, ``b``).

    Union-find contracts the links inside each task. Then rounds of star steps follow:
    each id links all its larger neighbours, next all its smaller ones, to the least
    neighbour it knows, until every id hangs on its component's least id. Minima are
    combined before each shuffle, so a much-linked id is one row per task there. Self
    links and nulls are ignored; an empty table has no components.
    """
    clean = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a is not null and b is not null and a <> b")
    edges = cut_lineage(clean.mapInArrow(_contract, "a long, b long").distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    before = None
    while True:
        # a > b throughout: a hangs on b
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least.select(F.col("a").alias("u"), "m"), "u")
        large = large.select(F.col("v").alias("a"), F.col("m").alias("b"))
        # every id keeps its own least neighbour, so no link is lost
        own = least.filter("m < a").select("a", F.col("m").alias("b"))
        large = large.unionByName(own).filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        edges = cut_lineage(
            joined.select("a", F.col("m").alias("b"))
            .unionByName(joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        state = edges.agg(
            F.count("*"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before and state[0] == state[1]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before = state
