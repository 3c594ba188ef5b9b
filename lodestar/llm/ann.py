"""Nearest neighbours by cosine on robust-pruned directed graphs, one per shard.

Equal vectors form one node, so copies cost nothing and ties among them are exact. Nodes
are dealt to shards by hash; a shard holds about ``SHARD_SCALE * sqrt(nodes)`` of them, so
that shards and their number grow alike. In a shard every node searches the graph built
so far, and of the nodes met it keeps a diverse few: a candidate is dropped when a kept
one is nearer to it by the factor ``ALPHA`` than the node itself. Queries then search every
shard with a beam, and what they meet is scored anew in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do rows with a null id. Vectors meet only those of their own length.
Repeated rows count once. Ties go to the smaller id. Fewer candidates than asked for come
back as they are. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestar.llm.common import bound_arrow_batches, cut_lineage

DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 24, 48, 96, 1.2
#: Nodes of a shard for each square root of all nodes.
SHARD_SCALE = 32
#: Nodes a beam opens at a time, and nodes or queries handled together.
OPENED, BATCH = 4, 256


def usable(vector: Column) -> Column:
    """True for vectors with a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce(vector.isNotNull() & finite & (length > 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def beam_search(unit: np.ndarray, links: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes met nearest to each query and their squared distances; -1 and infinity fill up."""
    n, width = len(queries), links.shape[1]
    ids = np.full((n, beam), -1)
    dist = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = 2 - 2 * queries @ unit[entry]
    while True:
        wait = ~done
        live = np.flatnonzero(wait.any(axis=1))
        if not len(live):
            return ids, dist
        # the nearest few nodes not opened yet
        order = np.argsort(np.where(wait[live], dist[live], np.inf), axis=1)[:, :OPENED]
        opened = np.take_along_axis(wait[live], order, axis=1)
        node = np.where(opened, np.take_along_axis(ids[live], order, axis=1), -1)
        mark = done[live]
        np.put_along_axis(mark, order, True, axis=1)
        near = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(live), OPENED * width)
        far = 2 - 2 * np.einsum("nrd,nd->nr", unit[near], queries[live])
        far[near < 0] = np.inf
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_dist = np.concatenate([dist[live], far], axis=1)
        all_done = np.concatenate([mark, near < 0], axis=1)
        # by id, what the beam holds first, to find nodes met before
        by_id = np.argsort(all_ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(all_ids, by_id, axis=1)
        again = np.zeros(sorted_ids.shape, bool)
        again[:, 1:] = (sorted_ids[:, 1:] == sorted_ids[:, :-1]) & (sorted_ids[:, 1:] >= 0)
        repeat = np.zeros(again.shape, bool)
        np.put_along_axis(repeat, by_id, again, axis=1)
        all_dist[repeat], all_done[repeat], all_ids[repeat] = np.inf, True, -1
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, axis=1)
        dist[live] = np.take_along_axis(all_dist, best, axis=1)
        done[live] = np.take_along_axis(all_done, best, axis=1) | (ids[live] < 0)


def robust_prune(unit: np.ndarray, nodes: np.ndarray, ids: np.ndarray, dist: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node among its candidates (-1: none)."""
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, axis=1), np.take_along_axis(dist, order, axis=1)
    alive = (ids >= 0) & (ids != nodes[:, None]) & np.isfinite(dist)
    vectors = unit[ids]
    out = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for k in range(degree):
        has = alive.any(axis=1)
        if not has.any():
            break
        pick = alive.argmax(axis=1)
        out[has, k] = ids[rows, pick][has]
        between = 2 - 2 * np.einsum("ncd,nd->nc", vectors, vectors[rows, pick])
        alive &= alpha * between > dist
        alive[rows, pick] = False
    return out


def build_graph(unit: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 3) -> tuple[np.ndarray, int]:
    """Neighbour lists of every node and the node where searches begin."""
    n = len(unit)
    rng = np.random.default_rng(seed)
    entry = int(np.argmax(unit @ unit.mean(axis=0)))
    links = np.full((n, degree), -1)
    if n > 1:
        links[:, : min(degree // 2, n - 1)] = (np.arange(n)[:, None] + rng.integers(1, n, (n, min(degree // 2, n - 1)))) % n
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            nodes = order[at : at + BATCH]
            ids, dist = beam_search(unit, links, entry, unit[nodes], beam)
            old = links[nodes]
            old_dist = np.where(old >= 0, 2 - 2 * np.einsum("nrd,nd->nr", unit[old], unit[nodes]), np.inf)
            both = np.concatenate([ids, np.where((old[:, :, None] == ids[:, None, :]).any(axis=2), -1, old)], axis=1)
            links[nodes] = robust_prune(unit, nodes, both, np.concatenate([dist, old_dist], axis=1), alpha, degree)
            _link_back(unit, links, nodes, alpha)
    return links, entry


def _link_back(unit: np.ndarray, links: np.ndarray, nodes: np.ndarray, alpha: float) -> None:
    """Let the new neighbours of ``nodes`` point back, pruning lists that overflow."""
    degree = links.shape[1]
    source = np.repeat(nodes, degree)
    target = links[nodes].reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    known = (links[target] == source[:, None]).any(axis=1)
    source, target = source[~known], target[~known]
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    owners, first, count = np.unique(target, return_index=True, return_counts=True)
    more = np.full((len(owners), int(count.max())), -1)
    column = np.arange(len(target)) - np.repeat(first, count)
    more[np.repeat(np.arange(len(owners)), count), column] = source
    for at in range(0, len(owners), BATCH):
        own = owners[at : at + BATCH]
        both = np.concatenate([links[own], more[at : at + BATCH]], axis=1)
        full = (both >= 0).sum(axis=1) > degree
        if (~full).any():
            packed = np.take_along_axis(both[~full], np.argsort(both[~full] < 0, axis=1, kind="stable"), axis=1)
            links[own[~full]] = packed[:, :degree]
        if full.any():
            dist = 2 - 2 * np.einsum("nrd,nd->nr", unit[both[full]], unit[own[full]])
            dist[both[full] < 0] = np.inf
            links[own[full]] = robust_prune(unit, own[full], both[full], dist, alpha, degree)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_INDEX = "dim int, shard long, node int, entry int, ids array<long>, vector array<float>, links array<int>"


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    dim, shard = key[0].as_py(), key[1].as_py()
    rows = rows.sort_by("first_id")  # the same graph whatever order the rows came in
    links, entry = build_graph(_unit(_matrix(rows.column("vector"), dim)))
    n = len(rows)
    flat = links[links >= 0].astype(np.int32)
    ends = np.concatenate([[0], np.cumsum((links >= 0).sum(axis=1))]).astype(np.int32)
    return pa.table(
        {
            "dim": pa.array(np.full(n, dim, np.int32)),
            "shard": pa.array(np.full(n, shard, np.int64)),
            "node": pa.array(np.arange(n, dtype=np.int32)),
            "entry": pa.array(np.full(n, entry, np.int32)),
            "ids": rows.column("ids"),
            "vector": rows.column("vector"),
            "links": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
        }
    )


def build_index(vectors: DataFrame, k: int) -> DataFrame:
    """Graph index of ``vectors`` (``vec_id, vector``) for searches of up to ``k`` neighbours.

    A node keeps the ``k + 1`` least ids of its copies: with ties to smaller ids and the
    query itself left out, no other copy can be among the ``k`` nearest.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(
        "vec_id", "vector", F.xxhash64("vector").alias("h")
    )
    order = Window.partitionBy("h", "vector").orderBy("vec_id")
    least = rows.withColumn("n", F.dense_rank().over(order)).filter(F.col("n") <= k + 1)
    nodes = least.groupBy("h", "vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    nodes = cut_lineage(nodes.select("h", "vector", "ids", F.col("ids")[0].alias("first_id"), F.size("vector").alias("dim")))
    shards = max(1, round(math.sqrt(nodes.count()) / SHARD_SCALE))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("h", F.lit(17)), F.lit(shards)))
    graph = dealt.select("dim", "shard", "vector", "ids", "first_id").groupBy("dim", "shard").applyInArrow(_build, _INDEX)
    return cut_lineage(graph)


class _Shard:
    """One shard's graph, ready to be searched."""

    def __init__(self, index: pa.Table, dim: int) -> None:
        index = index.sort_by("node")
        vectors = _matrix(index.column("vector"), dim)
        self.unit = _unit(vectors)
        lists = index.column("links").combine_chunks()
        ends = np.asarray(lists.offsets)
        self.links = np.full((len(index), DEGREE), -1)
        count = np.diff(ends)
        self.links[np.arange(DEGREE) < count[:, None]] = np.asarray(lists.values)[ends[0] : ends[-1]]
        ids = index.column("ids").combine_chunks()
        self.id_ends, self.id_values = np.asarray(ids.offsets), np.asarray(ids.values)
        self.entry = index.column("entry")[0].as_py()
        self.double = vectors.astype(np.float64)
        self.norm = np.sqrt((self.double * self.double).sum(axis=1))

    def nearest(self, own: np.ndarray, asked: np.ndarray, k: int, beam: int) -> pa.RecordBatch:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        found, _ = beam_search(self.unit, self.links, self.entry, _unit(asked), beam)
        asked = asked.astype(np.float64)
        for q, nodes in enumerate(found):
            nodes = nodes[nodes >= 0]
            score = (self.double[nodes] * asked[q]).sum(axis=1) / (self.norm[nodes] * np.sqrt((asked[q] * asked[q]).sum()))
            copies = self.id_ends[nodes + 1] - self.id_ends[nodes]
            each = np.concatenate([self.id_values[self.id_ends[i] : self.id_ends[i + 1]] for i in nodes])
            score = np.repeat(score, copies)
            other = each != own[q]
            each, score = each[other], score[other]
            best = np.lexsort((each, -score))[:k]
            out.append((np.full(len(best), own[q]), each[best], score[best]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], schema=_FOUND)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k: int, beam: int) -> Callable:
    """Answers of shards, each of whose nodes come before its queries; queries are held ``BATCH`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        parts: list[pa.RecordBatch] = []
        shard: _Shard | None = None
        for batch in batches:
            dims, shards, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "shard", "asked"))
            cut = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(asked) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if a == b:
                    continue
                own = (int(dims[a]), int(shards[a]))
                if own != key:
                    key, parts, shard = own, [], None
                if not asked[a]:
                    parts.append(batch.slice(a, b - a))
                    continue
                if shard is None:
                    shard = _Shard(pa.Table.from_batches(parts).select(["node", "entry", "ids", "vector", "links"]), key[0])
                    parts = []
                for at in range(a, b, BATCH):
                    rows = pa.Table.from_batches([batch.slice(at, min(BATCH, b - at))])
                    yield shard.nearest(rows.column("query_id").to_numpy(), _matrix(rows.column("query"), key[0]), k, beam)

    return run


def search_index(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every query (``query_id, query``).

    A node with the query's own id is left out of its result.
    """
    asked = queries.filter(F.col("query_id").isNotNull() & usable(F.col("query"))).dropDuplicates(["query_id", "query"])
    shards = index.select("dim", "shard").distinct()
    sent = asked.join(shards, F.size("query") == F.col("dim")).withColumn("asked", F.lit(1))
    # the queries of a shard pass by behind its nodes, so that a task never holds all of them
    both = index.withColumn("asked", F.lit(0)).unionByName(sent, allowMissingColumns=True)
    bound_arrow_batches(index.sparkSession)
    dealt = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asked")
    found = dealt.mapInArrow(_search(k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
