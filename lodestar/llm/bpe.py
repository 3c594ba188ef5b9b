"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are cut into pre-tokens by character classes, a batch at a time. The distinct
pre-tokens of a piece are looked up in a minimal perfect hash over the vocabulary, which
answers for all of them at once; bytes are compared, so a stray hit cannot pass. Only
the rest is merged, by a heap of the best pairs over a linked list of its bytes, and the
result is remembered within bounds.

Defined cases: a null text encodes as an empty one, to no ids. A null list of ids decodes
to null; null ids decode to nothing and ids outside the vocabulary to the replacement
character. Equal texts have equal ids. Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestar.llm.common import bound_arrow_batches, frugal, small_batches
from lodestar.llm.words import hash_spans, mix, text_bytes

#: Text encoded at a time.
PIECE_BYTES = 1 << 19
#: Pre-tokens whose merges a worker remembers at most.
MEMO_ENTRIES = 150_000
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: one slot for each key and none over.

    Keys fall into buckets; the larger buckets choose, first, a displacement that sends
    all their keys to free slots. A bucket of one key names its slot outright.
    """

    def __init__(self, keys: np.ndarray) -> None:
        n = len(keys)
        self.size, self.buckets = n, max(1, n // 3)
        self.shift = np.zeros(self.buckets, np.int64)
        where = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        first = np.searchsorted(where[order], np.arange(self.buckets + 1))
        sizes = np.diff(first)
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            own = keys[order[first[b] : first[b + 1]]]
            if len(own) < 2:
                break
            for base in itertools.count(0, 128):
                shifts = np.arange(base + 1, base + 129, dtype=np.uint64)
                slots = np.sort(self._slots(own[None, :], shifts[:, None]), axis=1)
                fits = free[slots].all(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(fits.argmax())
                    break
            self.shift[b] = int(shifts[k])
            free[slots[k]] = False
        lone = np.flatnonzero(sizes == 1)
        self.shift[lone] = -1 - np.flatnonzero(free)[: len(lone)]

    def _slots(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + shift * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(self.size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot for a key outside the set."""
        shift = self.shift[(keys % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._slots(keys, shift.astype(np.uint64)))


_classes: list[np.ndarray] = []


def character_classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    if not _classes:
        points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        every, at = "".join(map(chr, points)), np.array(points)
        table = np.zeros(0x110000, np.uint8)
        for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(name, every):
                table[at[m.start() : m.end()]] = kind
        _classes.append(table)
    return _classes[0]


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte where each begins."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[start].astype(np.int32)
    for least, mask, more in ((0xF0, 0x07, 3), (0xE0, 0x0F, 2), (0xC0, 0x1F, 1)):
        on = np.flatnonzero((data[start] >= least) & (data[start] < {3: 0xF8, 2: 0xF0, 1: 0xE0}[more]))
        value = data[start[on]].astype(np.int32) & mask
        for k in range(1, more + 1):
            value = (value << 6) | (data[np.minimum(start[on] + k, len(data) - 1)] & 0x3F)
        lead[on] = value
    return lead, start


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where pre-tokens begin, for rows of UTF-8 bytes.

    A run of letters, numbers or other signs is a pre-token, with one space before it if
    there is any. The rest of a run of white space is one of its own. An apostrophe that
    begins a pre-token takes a contraction's letters and no more.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    point, at = _code_points(data)
    n = len(point)
    kind = character_classes()[point]
    row = np.zeros(n + 4, bool)
    row[np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])] = True
    row[n:] = True
    fresh = row[:n].copy()
    fresh[1:] |= kind[1:] != kind[:-1]
    begin = np.concatenate([fresh, np.ones(4, bool)])
    runs = np.flatnonzero(fresh)
    ends = np.append(runs[1:], n)
    gap = (kind[runs] == _SPACE) & ~row[ends]  # white space before a sign of the same row
    s, e = runs[gap], ends[gap]
    begin[e[e - s > 1] - 1] = True
    begin[e[point[e - 1] == 32]] = False
    padded = np.concatenate([point, np.zeros(4, np.int32)])
    quote = runs[(point[runs] == 39) & begin[runs]]
    one, two = padded[quote + 1], padded[quote + 2]
    short = ~row[quote + 1] & np.isin(one, [ord(c) for c in "stmd"])
    pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
    long = ~row[quote + 1] & ~row[quote + 2] & np.any([(one == a) & (two == b) for a, b in pairs], axis=0)
    begin[quote[short | long] + 1] = False
    begin[quote[short] + 2] = True
    begin[quote[long] + 3] = True
    return at[begin[:n]]


@dataclass
class Tokenizer:
    """Vocabulary by rank, with its perfect hash and the bytes of every rank."""

    ranks: dict[bytes, int]
    memo: dict[bytes, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        tokens = sorted(self.ranks, key=self.ranks.get)
        lengths = np.array([len(t) for t in tokens])
        self.token_ids = np.array([self.ranks[t] for t in tokens], np.int32)
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_start = np.concatenate([[0], np.cumsum(lengths)])
        keys = hash_spans(self.token_bytes, self.token_start[:-1], self.token_start[1:])
        self.hash = PerfectHash(keys)
        self.slot_token = np.empty(len(tokens), np.int64)
        self.slot_token[self.hash.slots(keys)] = np.arange(len(tokens))
        self.pairs = [self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.slot_key = np.empty(len(tokens), np.uint64)
        self.slot_key[self.hash.slots(keys)] = keys

    def __getstate__(self) -> dict:
        return {**self.__dict__, "memo": {}}

    def known(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Index of the vocabulary token equal to each span, or -1."""
        slot = self.hash.slots(keys)
        token = self.slot_token[slot]
        length = self.token_start[token + 1] - self.token_start[token]
        hit = np.flatnonzero((self.slot_key[slot] == keys) & (length == end - start))
        same = data[_ragged(start[hit], length[hit])] == self.token_bytes[_ragged(self.token_start[token[hit]], length[hit])]
        wrong = np.concatenate([[0], np.cumsum(~same)])
        edge = np.concatenate([[0], np.cumsum(length[hit])])
        out = np.full(len(start), -1)
        good = wrong[edge[1:]] == wrong[edge[:-1]]
        out[hit[good]] = token[hit[good]]
        return out

    def merge(self, token: bytes) -> bytes:
        """Packed ids of one pre-token; its bytes merge the best pair first, the leftmost of equals."""
        n, ranks, pairs = len(token), self.ranks, self.pairs
        bits = n.bit_length()
        mask = (1 << bits) - 1
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # a heap entry is rank, place and end of a pair in one integer
        heap = [
            (((rank << bits) | i) << bits) | (i + 2)
            for i, pair in enumerate(zip(token, token[1:]))
            if (rank := pairs[(pair[0] << 8) | pair[1]]) >= 0
        ]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            end, i = entry & mask, (entry >> bits) & mask
            j = after[i]
            if j < 0 or j >= n or after[j] != end:
                continue  # one of the two parts has grown or gone since
            after[i], after[j] = end, -1
            if end < n:
                before[end] = i
                far = after[end]
                rank = ranks.get(token[i:far])
                if rank is not None:
                    heapq.heappush(heap, (((rank << bits) | i) << bits) | far)
            k = before[i]
            if k >= 0:
                rank = ranks.get(token[k:end])
                if rank is not None:
                    heapq.heappush(heap, (((rank << bits) | k) << bits) | end)
        ids, i = [], 0
        while i < n:
            j = after[i]
            ids.append(ranks[token[i:j]])
            i = j
        return array("i", ids).tobytes()

    def merged(self, tokens: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens, remembered within :data:`MEMO_ENTRIES`."""
        memo, out = self.memo, []
        if len(memo) > MEMO_ENTRIES:  # the older half goes
            for token in list(itertools.islice(memo, len(memo) // 2)):
                del memo[token]
        for token in tokens:
            ids = memo.get(token)
            if ids is None:
                ids = self.merge(token)
                if len(token) <= 64:
                    memo[token] = ids
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in one array, and the offsets of the rows."""
        data, offsets = text_bytes(texts)
        start = pretoken_starts(data, offsets)
        end = np.append(start[1:], len(data))[: len(start)]
        keys = hash_spans(data, start, end)
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        ours = (end[first] - start[first])[which]
        if len(start) and not (
            np.array_equal(ours, end - start) and np.array_equal(data, data[_ragged(start[first][which], ours)])
        ):  # two pre-tokens with one hash: take each by itself
            first = which = np.arange(len(start))
        token = self.known(data, start[first], end[first], keys[first])
        count = np.ones(len(first), np.int64)
        rest = np.flatnonzero(token < 0)
        raw = data.tobytes()
        merged = self.merged([raw[a:b] for a, b in zip(start[first[rest]].tolist(), end[first[rest]].tolist())])
        count[rest] = np.array([len(m) for m in merged], np.int64) >> 2
        place = np.concatenate([[0], np.cumsum(count)])
        flat = np.empty(place[-1], np.int32)
        simple = token >= 0
        flat[place[:-1][simple]] = self.token_ids[token[simple]]
        flat[_ragged(place[:-1][rest], count[rest])] = np.frombuffer(b"".join(merged), np.int32)
        ids = flat[_ragged(place[:-1][which], count[which])]
        total = np.concatenate([[0], np.cumsum(count[which])])
        return ids, total[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows in one array, and the offsets of the rows."""
        n = len(self.token_ids)
        place = np.full(max(int(self.token_ids.max(initial=0)) + 1, 1), n)
        place[self.token_ids] = np.arange(n)
        index = np.where((ids >= 0) & (ids < len(place)), place[np.clip(ids, 0, len(place) - 1)], n)
        table = np.concatenate([self.token_bytes, np.frombuffer("\N{REPLACEMENT CHARACTER}".encode(), np.uint8)])
        starts = np.append(self.token_start, len(table))
        length = starts[index + 1] - starts[index]
        total = np.concatenate([[0], np.cumsum(length)])
        return table[_ragged(starts[index], length)], total[offsets]


def load_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer of a rank file on every executor; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(Tokenizer(read_ranks(path)))


def encode_documents(docs: DataFrame, tokenizer: Broadcast) -> DataFrame:
    """``doc_id, ids`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PIECE_BYTES):
            ids, rows = tokenizer.value.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    bound_arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(run), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: Broadcast) -> DataFrame:
    """``doc_id, ids, decoded`` of every list of ids; ``decoded`` is binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column("ids")
                rows = np.asarray(lists.offsets).astype(np.int64)
                flat = lists.values.slice(rows[0], rows[-1] - rows[0])
                rows -= rows[0]
                if flat.null_count:
                    kept = np.asarray(flat.is_valid())
                    rows = np.concatenate([[0], np.cumsum(kept)])[rows]
                    flat = flat.drop_null()
                data, offsets = tokenizer.value.decode(flat.to_numpy(), rows)
                out = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
                ).cast(pa.binary())
                if lists.null_count:
                    out = pa.array([v if ok else None for v, ok in zip(out.to_pylist(), lists.is_valid().to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, out], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(frugal(run), "doc_id long, ids array<int>, decoded binary")
