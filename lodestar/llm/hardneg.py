"""Hard negatives by the threshold algorithm on sorted lists per dimension.

Vectors become integers, ``floor(256 x)``, and a row's score for an anchor is their inner
product. The positives of an anchor are its best rows of the same label. Each positive
opens a window of scores, from a share of the positive's score up to that score, and the
best rows of other labels in the window are the hard negatives.

Rows are dealt into shards, by label where a label fills one, else with other labels, so
that anchors look for positives in shards of their own label and for negatives in the
others. A shard has a list of its rows per dimension, sorted by the value there. An anchor
reads each list from the end that its own sign prefers, and scores every row it meets for
the first time. No row that it has not met can score above the threshold, the score of a
row made of the lists' next values; once that is strictly below the k-th score of every
window, or below the window itself, the search of the shard ends. The results of all
shards meet in one ranking of ``k`` rows per shard and window.

A shard's rows come before its anchors in its partition and anchors are read a batch at
a time, so a task holds one shard. Shards grow with the root of the rows; labels, dimensions and copies of any
size are split by it. Every anchor is held against all rows, which the operator is for;
lists only save what the threshold proves needless.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part. ``label`` is an integer. Vectors of different
lengths do not meet. A row is no candidate for an anchor of its own id. Repeated rows are
rows of their own, as anchors too. An anchor without positives has no result, nor has a positive of negative
score, whose window is empty. Scores are exact where every sum of products is below 2**63; larger ones are
counted in Python integers, and come out at the ends of the long range. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestar.llm.common import bound_arrow_batches, cut_lineage

#: Rows of a shard: ``SHARD_SCALE`` times the root of all rows, and never fewer than ``LEAST_SHARD``.
SHARD_SCALE, LEAST_SHARD = 32, 4096
#: Positions of every list that one step reads at first; steps double.
FIRST_STEP = 8
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least this many hundredths of the positive's.
LEAST_SHARE = 80

_LONG = (1 << 63) - 1


def quantised(vector: Column) -> Column:
    """``floor(256 x)`` of the components, as doubles, which hold them exactly."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double"))


def usable(vector: Column) -> Column:
    """True for vectors whose components are all finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | F.abs(x).isin(float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


class SortedLists:
    """The rows of a shard and a sorted list of them per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.rows = ids[by_id], labels[by_id], rows[by_id]
        #: ``order[d]`` are the rows by falling value in dimension ``d``.
        self.order = np.argsort(-self.rows, axis=0, kind="stable").T.astype(np.int32)
        self.reach = float(np.abs(self.rows).sum(axis=1).max(initial=0))
        self.exact = self.reach < 2**53

    def _scores(self, at: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        if exact:  # sums of products below 2**53 are exact in doubles in any order
            return (self.rows[at] @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        sums = [sum(int(x) * y for x, y in zip(row, whole)) for row in self.rows[at]]
        return np.array([max(-_LONG, min(_LONG, s)) for s in sums], dtype=np.int64)

    def search(
        self, anchor_id: int, anchor: np.ndarray, label: object, same: bool, windows: list[tuple[int | None, int | None]], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the ``k`` best rows in each window (``low, high``), by score and then id.

        Rows have the anchor's label if ``same``, another one otherwise.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor)
        exact = self.exact and self.reach * float(np.abs(anchor).max(initial=0)) < 2**53
        fits = ((self.labels == label) == same) & (self.ids != anchor_id)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        if not fits.any() or not windows:
            return best
        seen = np.zeros(n, bool)
        # rows met in a list that the anchor's sign reads from its lower end stand there in reverse
        falling = anchor[used] > 0
        at, step = 0, FIRST_STEP
        while at < n:
            to = min(n, at + step)
            if len(used):
                down = self.order[used[falling], at:to]
                up = self.order[used[~falling], n - to : n - at]
                met = np.zeros(n, bool)
                met[down] = True
                met[up] = True
                new = np.flatnonzero(met & ~seen)
                seen |= met
            else:  # every score is zero, and rows stand by id
                new, to = np.arange(n), n
            new = new[fits[new]]
            scores = self._scores(new, anchor, exact)
            for w, (low, high) in enumerate(windows):
                ok = np.ones(len(new), bool)
                if low is not None:
                    ok &= scores >= low
                if high is not None:
                    ok &= scores <= high
                ids = np.concatenate([best[w][0], self.ids[new[ok]]])
                own = np.concatenate([best[w][1], scores[ok]])
                first = np.lexsort((ids, -own))[:k]
                best[w] = ids[first], own[first]
            if to >= n or self._done(used, falling, anchor, to, exact, windows, best, k):
                break
            at, step = to, step * 2
        return best

    def _done(self, used, falling, anchor, to, exact, windows, best, k) -> bool:  # noqa: ANN001
        """True once no row still unmet can enter a window."""
        n = len(self.ids)
        last = np.where(falling, self.order[used, to - 1], self.order[used, n - to])
        values = self.rows[last, used]
        weights = anchor[used]
        if exact:
            threshold = int(values @ weights)
        else:
            threshold = sum(int(x) * int(y) for x, y in zip(values, weights))
        for (low, _), (ids, scores) in zip(windows, best):
            full = len(ids) >= k and threshold < scores[-1]
            if not full and not (low is not None and threshold < low):
                return False
        return True


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


_POSITIVE = "ask long, vec_id long, score long"
_NEGATIVE = "ask long, positive_id long, positive_score long, place int, vec_id long, score long"


def _passes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[SortedLists, pa.RecordBatch]]:
    """Every shard with its anchors, some at a time. A shard's rows come before its anchors."""
    key, parts, shard = None, [], None
    for batch in batches:
        dims, big, label, slot, asked = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "big", "of", "slot", "asked")
        )
        cut = np.zeros(batch.num_rows, bool)
        for c in (dims, big, label, slot, asked):
            cut[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            own = (dims[a], big[a], label[a], slot[a])
            if own != key:
                key, parts, shard = own, [], None
            rows = batch.slice(a, b - a)
            if not asked[a]:
                parts.append((rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("vector"), int(dims[a]))))
                continue
            if shard is None and parts:
                shard = SortedLists(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
                parts = []
            if shard is not None:
                yield shard, rows


def _positives(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _passes(batches):
            anchors = _matrix(rows.column("vector"), shard.rows.shape[1])
            out: list[tuple[np.ndarray, ...]] = []
            for i, (ask, own, label) in enumerate(zip(*(rows.column(c).to_numpy() for c in ("ask", "vec_id", "label")))):
                ids, scores = shard.search(own, anchors[i], label, True, [(None, None)], k)[0]
                out.append((np.full(len(ids), ask), ids, scores))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[i] for o in out]), pa.int64()) for i in range(3)], ["ask", "vec_id", "score"]
            )

    return run


def _negatives(k: int, share: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _passes(batches):
            anchors = _matrix(rows.column("vector"), shard.rows.shape[1])
            out: dict[str, list] = {c.split()[0]: [] for c in _NEGATIVE.split(", ")}
            asks = zip(*(rows.column(c).to_numpy() for c in ("ask", "vec_id", "label")), rows.column("positives").to_pylist())
            for i, (ask, own, label, positives) in enumerate(asks):
                windows = [(-((-share * p["score"]) // 100), p["score"]) for p in positives]
                found = shard.search(own, anchors[i], label, False, windows, k)
                for place, (p, (ids, scores)) in enumerate(zip(positives, found)):
                    for vec_id, score in zip(ids.tolist(), scores.tolist()):
                        for name, v in zip(out, (ask, p["vec_id"], p["score"], place, vec_id, score)):
                            out[name].append(v)
            kinds = [pa.int32() if c == "place" else pa.int64() for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    return run


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each ask."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the shard's ``big, of, slot`` and its label's number of ``slots``; and all shards.

    A label of a whole shard's rows or more has shards of its own: at most one for each so many rows.
    """
    sizes = cut_lineage(rows.groupBy("dim", "label").count())
    total = sizes.agg(F.sum("count")).first()[0] or 0
    most = max(LEAST_SHARD, round(SHARD_SCALE * math.sqrt(total)))
    big = sizes.filter(F.col("count") >= most).select("dim", "label", F.ceil(F.col("count") / most).cast("int").alias("own"))
    rest = sizes.filter(F.col("count") < most).groupBy("dim").agg(F.ceil(F.sum("count") / most).cast("int").alias("mixed"))
    known = rows.join(big, ["dim", "label"], "left").join(rest, "dim", "left")
    own = F.col("own").isNotNull()
    slot = F.when(own, F.pmod(F.xxhash64("ask"), F.col("own"))).otherwise(F.pmod(F.xxhash64("label"), F.col("mixed")))
    dealt = known.select(
        "dim", own.alias("big"), F.when(own, F.col("label")).otherwise(F.lit(0)).cast("long").alias("of"),
        slot.cast("int").alias("slot"), F.coalesce("own", F.lit(1)).alias("slots"), "anchor", "ask", "vec_id", "label", "vector",
    )
    shards = big.select("dim", F.lit(True).alias("big"), F.col("label").cast("long").alias("of"), F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("slot"))
    mixed = rest.select("dim", F.lit(False).alias("big"), F.lit(0).cast("long").alias("of"), F.explode(F.sequence(F.lit(0), F.col("mixed") - 1)).alias("slot"))
    return cut_lineage(dealt), cut_lineage(shards.unionByName(mixed))


def _searched(rows: DataFrame, asks: DataFrame, run: Callable, schema: str) -> DataFrame:
    shard = ["dim", "big", "of", "slot"]
    held = rows.select(*shard, F.lit(False).alias("asked"), "ask", "vec_id", "label", "vector")
    both = held.unionByName(asks.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    return both.repartition(*shard).sortWithinPartitions(*shard, "asked").mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: int = LEAST_SHARE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, vector``; the rows where ``anchors`` holds ask. Columns
    of other names are not read.
    """
    bound_arrow_batches(vectors.sparkSession)
    taking = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    picked = vectors.filter(taking).select(
        F.monotonically_increasing_id().alias("ask"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"), F.size("vector").alias("dim"), quantised(F.col("vector")).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows, shards = _dealt(cut_lineage(picked))
    asking = rows.filter("anchor")

    # positives: the shards of the anchor's label
    slot = F.when(F.col("big"), F.sequence(F.lit(0), F.col("slots") - 1)).otherwise(F.array("slot"))
    near = asking.select("dim", "big", "of", F.explode(slot).alias("slot"), "ask", "vec_id", "label", "vector")
    best = _first(_searched(rows, near, _positives(positives), _POSITIVE), ["ask"], positives)
    pairs = best.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    pairs = cut_lineage(pairs)

    # negatives: the shards that may hold other labels
    met = asking.join(pairs, "ask").select("dim", "ask", "vec_id", "label", "vector", "positives")
    far = met.join(shards, "dim").filter("not (big and of = label)").select(*shards.columns, *met.columns[1:])
    found = _searched(rows, far, _negatives(negatives, share), _NEGATIVE)
    ranked = _first(found, ["ask", "place"], negatives)
    return ranked.join(asking.select("ask", F.col("vec_id").alias("anchor_id")), "ask").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
