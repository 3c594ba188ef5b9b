"""Benchmark decontamination by suffix arrays of the training text.

Every task cuts its documents into shards and sorts the suffixes of each shard. All
suffixes of the benchmark are then looked up by binary search, all at once. A suffix of
the training text none of whose next words are benchmark words can match nothing and is
left out of the array, which keeps shards small without changing a result. Neighbouring
matches on one diagonal join into the longest verbatim match and its place.

The benchmark is read in blocks of a set size (:data:`BLOCK_BYTES`), each broadcast
alone; a larger benchmark takes one pass over the documents per block.

Defined cases: a null or word-free text has no words and no hits. A benchmark item
without words has no window; one of fewer words than a window is a window itself. Items
with a null id count for hits but are not listed; repeated items count once. An empty
benchmark leaves all documents clean. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from lodestar.llm.common import bound_arrow_batches, cut_lineage, small_batches
from lodestar.llm.words import ALNUM, Words, split_words

WINDOW = 10
#: Benchmark text in one broadcast, and document text in one shard.
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 2 << 20
_FILTER_BITS = 20


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` (``count[i]`` values) for every i."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class TestSuffixes:
    """Distinct windows of a benchmark block and where they stand in its items."""

    window: int
    vocabulary: np.ndarray
    present: np.ndarray
    bits: int
    low: list[np.ndarray]
    high: list[np.ndarray]
    length: np.ndarray
    place_rows: np.ndarray
    place_item: np.ndarray
    place_word: np.ndarray
    item_ids: list[int | None]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word in the vocabulary, from 1; 0 for other words."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.present[hashes >> np.uint64(64 - _FILTER_BITS)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        found = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes[maybe]
        out[maybe[found]] = at[found] + 1
        return out

    def pack(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        return _pack(columns, self.bits)


def _pack(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Word ranks in as few sort keys as hold them."""
    per = 63 // bits
    keys = []
    for at in range(0, len(columns), per):
        key = np.zeros(len(columns[0]), np.int64)
        for c in columns[at : at + per]:
            key = (key << bits) | c
        keys.append(key)
    return keys


def _following(values: np.ndarray, at: np.ndarray, limit: np.ndarray, n: int, fill: int = 0) -> list[np.ndarray]:
    """The n values from each position on; ``fill`` at and beyond ``limit``."""
    if not len(values):
        return [np.full(len(at), fill, np.int64) for _ in range(n)]
    return [np.where(at + k < limit, values[np.minimum(at + k, len(values) - 1)], fill) for k in range(n)]


def index_benchmark(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> TestSuffixes | None:
    """Windows of the items; None when there is none."""
    words = split_words(pa.array([t for _, t in items], pa.large_string()), ALNUM)
    if not len(words.start):
        return None
    vocabulary, rank = np.unique(words.hash, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    bits = int(len(vocabulary) + 1).bit_length()
    count = np.diff(words.rows)
    made = np.where(count >= window, count - window + 1, (count > 0).astype(np.int64))
    at = _ragged(words.rows[:-1], made)
    item = np.repeat(np.arange(len(items)), made)
    length = np.minimum(count[item], window)
    low = _pack(_following(rank, at, at + length, window), bits)
    high = _pack(_following(rank, at, at + length, window, (1 << bits) - 1), bits)
    order = np.lexsort((*low[::-1], length))
    same = np.ones(len(order), bool)
    same[1:] = np.any([k[order][1:] != k[order][:-1] for k in (*low, length)], axis=0)
    group = np.cumsum(same) - 1
    first = order[same]
    present = np.zeros(1 << _FILTER_BITS, bool)
    present[vocabulary >> np.uint64(64 - _FILTER_BITS)] = True
    return TestSuffixes(
        window, vocabulary, present, bits, [k[first] for k in low], [k[first] for k in high], length[first],
        np.searchsorted(group, np.arange(group[-1] + 2)), item[order], (at - words.rows[:-1][item])[order], [i for i, _ in items],
    )


def _bisect(keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Insertion points of all wanted tuples in the sorted tuples of ``keys``."""
    lo = np.zeros(len(wanted[0]), np.int64)
    hi = np.full(len(lo), len(keys[0]), np.int64)
    while True:
        on = np.flatnonzero(lo < hi)
        if not len(on):
            return lo
        mid = (lo[on] + hi[on]) // 2
        less, equal = np.zeros(len(on), bool), np.ones(len(on), bool)
        for k, w in zip(keys, wanted):
            a, b = k[mid], w[on]
            less |= equal & (a < b)
            equal &= a == b
        up = less | equal if right else less
        lo[on[up]] = mid[up] + 1
        hi[on[~up]] = mid[~up]


def search_shard(words: Words, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of the shard and the test windows that begin there."""
    none = np.zeros(0, np.int64)
    rank = tests.ids(words.hash)
    limit = np.repeat(words.rows[1:], np.diff(words.rows))
    least = int(tests.length.min())
    foreign = np.concatenate([[0], np.cumsum(rank == 0)])
    place = np.arange(len(rank))
    held = place + least <= limit
    at = place[held]
    at = at[foreign[at + least] == foreign[at]]
    if not len(at):
        return none, none
    # the suffix array: retained suffixes in the order of their next words
    keys = tests.pack(_following(rank, at, limit[at], tests.window))
    order = np.lexsort(keys[::-1])
    suffixes, keys = at[order], [k[order] for k in keys]
    lo, hi = _bisect(keys, tests.low, False), _bisect(keys, tests.high, True)
    count = np.maximum(hi - lo, 0)
    return suffixes[_ragged(lo, count)], np.repeat(np.arange(len(lo)), count)


def _longest(words: Words, tests: TestSuffixes, pos: np.ndarray, win: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Longest match of every row and item: row, item, word of the row, word of the item, length."""
    count = np.diff(tests.place_rows)[win]
    place = _ragged(tests.place_rows[win], count)
    p, length = np.repeat(pos, count), np.repeat(tests.length[win], count)
    item, word = tests.place_item[place], tests.place_word[place]
    row = np.searchsorted(words.rows, p, "right") - 1
    order = np.lexsort((p, p - word, item, row))
    row, item, p, word, length = row[order], item[order], p[order], word[order], length[order]
    fresh = np.ones(len(p), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (p[1:] - word[1:] != p[:-1] - word[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(fresh)
    run = np.diff(np.append(first, len(p))) + length[first] - 1
    best = np.lexsort((p[first], -run, item[first], row[first]))
    f, run = first[best], run[best]
    top = np.ones(len(f), bool)
    top[1:] = (row[f][1:] != row[f][:-1]) | (item[f][1:] != item[f][:-1])
    f, run = f[top], run[top]
    return list(zip(row[f].tolist(), item[f].tolist(), (p[f] - words.rows[row[f]]).tolist(), word[f].tolist(), run.tolist()))


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Broadcast]:
    """Indexed blocks of the benchmark, one broadcast each."""
    bench = benchmark.select(F.col("item_id").cast("long"), "text")
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for i in range(n):
        part = bench if n == 1 else bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        tests = index_benchmark(sorted({(r[0], r[1]) for r in part.collect()}, key=repr), window)
        if tests is not None:
            yield benchmark.sparkSession.sparkContext.broadcast(tests)


def _cover(words: Words, pos: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Marks of the words inside any match."""
    marks = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(marks, pos, 1)
    np.add.at(marks, pos + length, -1)
    return np.cumsum(marks)[:-1] > 0


_MATCH = pa.struct([(n, pa.int64()) for n in ("item_id", "doc_word", "item_word", "n_words")])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_STATE = "doc_id long, text string, n_words long, spans array<struct<start:long,end:long>>, " \
    "matches array<struct<item_id:long,doc_word:long,item_word:long,n_words:long>>"  # fmt: skip


def _report(shared: Broadcast, last: bool):
    """Add the spans and matches of one block to every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: TestSuffixes = shared.value
        for batch in small_batches(batches, "text", SHARD_BYTES):
            words = split_words(batch.column("text"), ALNUM)
            pos, win = search_shard(words, tests)
            spans, matches = batch.column("spans").to_pylist(), batch.column("matches").to_pylist()
            if len(pos):
                mark = np.concatenate([[False], _cover(words, pos, tests.length[win]), [False]])
                start = np.flatnonzero(mark[1:] & ~mark[:-1])
                # a run of marked words may go on over the end of a row
                start = np.union1d(start, words.rows[:-1][(np.diff(words.rows) > 0) & mark[words.rows[:-1] + 1]])
                end = np.flatnonzero(mark[:-1] & ~mark[1:])
                end = np.union1d(end, words.rows[1:][(np.diff(words.rows) > 0) & mark[words.rows[1:]]])
                row = np.searchsorted(words.rows, start, "right") - 1
                for r, a, b in zip(row.tolist(), (start - words.rows[row]).tolist(), (end - words.rows[row]).tolist()):
                    spans[r].append({"start": a, "end": b})
                for r, item, dw, iw, n in _longest(words, tests, pos, win):
                    matches[r].append({"item_id": tests.item_ids[item], "doc_word": dw, "item_word": iw, "n_words": n})
            text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), text, pa.array(np.diff(words.rows), pa.int64()),
                    pa.array(spans, pa.list_(_SPAN)), pa.array(matches, pa.list_(_MATCH)),
                ],
                ["doc_id", "text", "n_words", "spans", "matches"],
            )

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", SHARD_BYTES):
        n = pa.array(np.diff(split_words(batch.column("text"), ALNUM).rows), pa.int64())
        at = batch.schema.get_field_index("n_words")
        yield batch.set_column(at, batch.schema.field(at), n)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated, matches`` of every document.

    ``n_hit`` counts the words inside any occurrence of a benchmark window, ``items``
    holds the distinct ids of the items with such windows, and ``matches`` the longest
    verbatim match of each of them and its place, in words.
    """
    bound_arrow_batches(docs.sparkSession)
    empty = [F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans")]
    matches = F.expr("cast(array() as array<struct<item_id:long,doc_word:long,item_word:long,n_words:long>>)").alias("matches")
    state = docs.select(F.col("doc_id").cast("long"), "text", *empty, matches)
    ran = False
    blocks = list(_blocks(benchmark, window, block_bytes))
    for k, shared in enumerate(blocks):
        state = state.mapInArrow(_report(shared, k == len(blocks) - 1), _STATE)
        state = state if k == len(blocks) - 1 else cut_lineage(state)
        ran = True
    if not ran:
        state = state.mapInArrow(_count_words, _STATE)
    # spans of different blocks may overlap: count up to the furthest end so far
    step = "named_struct('n', a.n + greatest(0L, s.end - greatest(s.start, a.upto)), 'upto', greatest(a.upto, s.end))"
    hit = F.expr(f"aggregate(array_sort(spans), named_struct('n', 0L, 'upto', 0L), (a, s) -> {step}, a -> a.n)")
    items = F.expr("array_sort(array_distinct(filter(transform(matches, m -> m.item_id), i -> i is not null)))")
    return state.select(
        "doc_id", "n_words", hit.alias("n_hit"), items.alias("items"), (F.size("spans") > 0).alias("contaminated"), "matches"
    )


def _clean(shared: Broadcast, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests: TestSuffixes = shared.value
        for batch in small_batches(batches, text, SHARD_BYTES):
            words = split_words(batch.column(text), ALNUM)
            pos, _ = search_shard(words, tests)
            clean = np.ones(batch.num_rows, bool)
            clean[np.searchsorted(words.rows, pos, "right") - 1] = False
            yield batch.filter(pa.array(clean))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns, without those that hold a benchmark window."""
    bound_arrow_batches(docs.sparkSession)
    out = docs
    for shared in _blocks(benchmark, window, block_bytes):
        out = out.mapInArrow(_clean(shared, "text"), docs.schema)
    return out
