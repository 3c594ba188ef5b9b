"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find.

Documents with equal shingle sets form one class by a digest of the set. The classes'
signatures are cut into bands; classes that share a band's hash meet in a bucket. In a
bucket every member is verified against the least one, which links the groups of copies
in one pass. Buckets whose members are then still in several components are compared
in blocks bounded by members and by shingles: the members outside a bucket's largest component meet all others, on full
sets, and only links come out. So the cost of a large group of copies is linear, and no
pair that shares a bucket is left out. Links are exact: intersections of whole sets of
64-bit shingle hashes, compared in integers.

Defined cases: null, empty and word-free texts have an empty set, link with nothing and
are their own component. A text of fewer words than a shingle is one shingle. Repeated
rows give repeated results; rows that share an id are judged text by text under that id. A null id
stays alone: its component is null and it is kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodestar.llm.common import bound_arrow_batches, cut_lineage, frugal, small_batches
from lodestar.llm.components import UnionFind, connected_components
from lodestar.llm.superminhash import signatures
from lodestar.llm.words import SPACED, mix, ngram_hashes, split_words

#: 32 bands of 6 values: a pair at similarity 0.85 shares no band with probability 3e-7, at 0.8 with 7e-5.
BANDS, BAND_ROWS = 32, 6
#: Members of a bucket that one block compares, and about how many shingles they have; a larger set is a block of its own.
BLOCK, BLOCK_SHINGLES = 256, 1 << 18


def _sets(texts: pa.Array, words_per_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted, and their offsets."""
    hashes, rows = ngram_hashes(split_words(texts, SPACED), words_per_shingle)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[first], r[first]
    return h, np.searchsorted(r, np.arange(len(rows)))


def _listed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _featurise(words_per_shingle: int, bands: int, band_rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            h, rows = _sets(batch.column("text"), words_per_shingle)
            size = np.diff(rows)
            n = len(size)
            # two independent sums over the set and its size name the class
            total = np.concatenate([[0], np.cumsum(mix(h))]).astype(np.uint64)
            other = np.concatenate([[0], np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))]).astype(np.uint64)
            sig = signatures(h, rows, bands * band_rows).reshape(n, bands, band_rows)
            key = np.zeros((n, bands), np.uint64)
            for k in range(band_rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k] + np.uint64(k + 1))
            key = mix(key + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size.astype(np.int64)),
                    pa.array((total[rows[1:]] - total[rows[:-1]]).view(np.int64)),
                    pa.array((other[rows[1:]] - other[rows[:-1]]).view(np.int64)),
                    _listed(key.reshape(-1), np.arange(n + 1) * bands),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return run


def _hash_sets(words_per_shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            h, rows = _sets(batch.column("text"), words_per_shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _listed(h, rows)], ["doc_id", "hashes"])

    return run


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(name)
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _verify(percent: int) -> Callable:
    """Links among pairs whose two sets stand in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(_lists(batch, "x"), _lists(batch, "y"))):
                both = np.concatenate([x, y])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                if 100 * inter >= percent * (len(x) + len(y) - inter):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _block_links(percent: int) -> Callable:
    """Links between the queries of a block and its members, one per pair of components."""

    def run(_: tuple, batches: pa.Table) -> pa.Table:
        doc = batches.column("doc_id").to_numpy()
        comp = batches.column("comp").to_numpy()
        asks = batches.column("asks").to_numpy(zero_copy_only=False)
        sets = _lists(batches.combine_chunks().to_batches()[0], "hashes")
        size = np.array([len(s) for s in sets])
        members = np.flatnonzero(~asks)
        groups, out = UnionFind(), []
        if len(members):
            owner = np.repeat(np.arange(len(members)), size[members])
            values = np.concatenate([sets[i] for i in members])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for q in np.flatnonzero(asks):
                lo, hi = np.searchsorted(values, sets[q]), np.searchsorted(values, sets[q], "right")
                n = hi - lo
                picked = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                inter = np.bincount(owner[picked], minlength=len(members))
                near = 100 * inter >= percent * (size[members] + size[q] - inter)
                for k in members[near]:
                    if groups.union(int(comp[q]), int(comp[k])):
                        out.append((int(doc[q]), int(doc[k])))
        return pa.table({k: pa.array([p[i] for p in out], pa.int64()) for i, k in enumerate("ab")})

    return run


def _with_component(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Component of every ``doc_id``; its own id where it has no link."""
    found = connected_components(links)
    return rows.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "comp", F.coalesce("component", "doc_id")
    ).drop("component")


def near_duplicates(
    docs: DataFrame,
    words_per_shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    block: int = BLOCK,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (``doc_id, text``).

    Two documents are linked when ``100 * intersection >= percent * union`` of their
    sets of distinct shingles.
    """
    bound_arrow_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
    features = cut_lineage(source.mapInArrow(frugal(_featurise(words_per_shingle, bands, band_rows)), schema))
    known = features.filter("doc_id is not null and n_shingles > 0")
    set_key = ["n_shingles", "set_a", "set_b"]
    classes = known.groupBy(*set_key).agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    classes = cut_lineage(classes.withColumnRenamed("doc_id", "rep"))

    entries = classes.select(F.col("rep").alias("doc_id"), "n_shingles", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("doc_id").alias("centre"), F.min_by("n_shingles", "doc_id").alias("n_centre")
    )
    shared = cut_lineage(entries.join(buckets.filter("members > 1"), "bucket"))
    pairs = cut_lineage(
        shared.filter("doc_id <> centre")
        .filter(f"100 * least(n_shingles, n_centre) >= {percent} * greatest(n_shingles, n_centre)")
        .select(F.col("doc_id").alias("a"), F.col("centre").alias("b"))
        .distinct()
    )
    wanted = shared.select("doc_id").distinct()
    texts = source.join(wanted, "doc_id", "left_semi")
    sets = cut_lineage(texts.mapInArrow(frugal(_hash_sets(words_per_shingle)), "doc_id long, hashes array<long>"))

    def verified(candidates: DataFrame) -> DataFrame:
        left = candidates.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a")
        both = left.join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(frugal(_verify(percent)), "a long, b long")

    links = cut_lineage(verified(pairs))
    labelled = cut_lineage(_with_component(shared.select("bucket", "doc_id", "n_shingles"), links))

    # what the centres left apart: members outside the largest component meet all others
    parts = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    split = parts.groupBy("bucket").agg(
        F.count("*").alias("parts"),
        F.sum("size").alias("members"),
        F.max("size").alias("largest"),
        F.max_by("comp", F.struct("size", "comp")).alias("main"),
        F.sum("weight").alias("weight"),
        F.max_by("weight", F.struct("size", "comp")).alias("main_weight"),
    )
    left = labelled.join(split.filter("parts > 1"), "bucket")

    def blocks_of(rows: str, shingles: str) -> Column:
        return F.ceil(F.greatest(F.expr(rows) / block, F.expr(shingles) / block_shingles))

    member_blocks, ask_blocks = blocks_of("members", "weight"), blocks_of("members - largest", "weight - main_weight")

    def every(blocks: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))

    def slot(blocks: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id"), blocks)

    member = left.select(
        "bucket", "doc_id", "comp", F.lit(False).alias("asks"), slot(member_blocks).alias("m"), every(ask_blocks).alias("q")
    )
    ask = left.filter("comp <> main").select(
        "bucket", "doc_id", "comp", F.lit(True).alias("asks"), slot(ask_blocks).alias("q"), every(member_blocks).alias("m")
    )
    rows = member.unionByName(ask).join(sets, "doc_id")
    more = rows.select("bucket", "m", "q", "doc_id", "comp", "asks", "hashes").groupBy("bucket", "m", "q").applyInArrow(
        _block_links(percent), "a long, b long"
    )
    all_links = links.unionByName(cut_lineage(more))
    reps = _with_component(classes.select(F.col("rep").alias("doc_id"), *set_key), all_links)
    reps = cut_lineage(reps.select(*set_key, "comp"))
    joined = features.join(reps, set_key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
