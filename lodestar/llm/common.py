"""Shared folders, labelled samples and Arrow helpers of the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.session import cut_lineage, shared_folder

__all__ = [
    "bound_arrow_batches", "cut_lineage", "frugal", "held_out", "release_memory", "shared_folder", "slices",
    "small_batches", "spread_sample", "table",
]

#: Bytes of one of the stretches in which a long text is read for a sample bounded by its bytes.
STRETCH_BYTES = 1 << 10


#: Rows and bytes of an Arrow batch between Spark and a Python worker; a larger row is a batch of its own.
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _learnable(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, y`` of the ids that may be learnt: not null, not held out, without contradicting labels."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("z"))
        .filter("y = z")
        .select("doc_id", F.col("y").cast("int").alias("y"))
    )


def _level(sizes: list[int], total: int) -> int:
    """The size to which the longest have to come down so that all sizes add up to ``total`` at most."""
    left = total
    for k, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - k) > left:
            return left // (len(sizes) - k)
        left -= size
    return max(sizes, default=0)


def spread(text: str, most: int) -> str:
    """``text``, or stretches at equal distances from its beginning to its end with ``most`` bytes in all."""
    data = text.encode()
    if len(data) <= most:
        return text
    n = max(2, most // STRETCH_BYTES)
    size = most // n
    starts = [k * (len(data) - size) // (n - 1) for k in range(n)]
    return "\n".join(data[a : a + size].decode(errors="ignore") for a in starts)


def _spread_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        texts = [spread(t, m) for t, m in zip(batch.column("text").to_pylist(), batch.column("most").to_pylist())]
        yield batch.set_column(1, "text", pa.array(texts, batch.schema.field("text").type))


def spread_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, total_bytes: int, columns: Sequence[Column] = ()
) -> tuple[list, ...]:
    """Texts and labels of at most ``per_class`` training ids of each class, with ``total_bytes`` of text a class.

    With ``columns`` a third item holds the tuples of their values.

    No text is left out by its length. Ids are chosen by their hash from those that have a
    text. Where a class has more bytes, its longest texts come down to one size, and are
    read in stretches over their whole length (:func:`spread`). Held-out and null ids, and ids with contradicting
    labels, are not learnt.
    """
    bound_arrow_batches(docs.sparkSession)
    names = [f"m{i}" for i in range(len(columns))]
    texts = docs.select("doc_id", "text", *[c.alias(n) for c, n in zip(columns, names)]).filter(F.col("text").isNotNull())
    sized = texts.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("size"))
    known = _learnable(labels, label).join(sized, "doc_id")
    chosen = []
    for y in (0, 1):
        rows = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
        level = _level([r["size"] for r in rows], total_bytes)
        chosen += [(r["doc_id"], y, r["size"] if r["size"] <= level else level // r["n"]) for r in rows]
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(chosen, f"doc_id {kind}, y int, most long")
    found = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y", "most", *names)
    rows = found.mapInArrow(_spread_texts, found.schema).collect()
    rows = sorted({(r["doc_id"], r["text"], r["y"], tuple(r[n] for n in names)) for r in rows}, key=lambda r: (r[:3], repr(r[3])))
    return ([r[1] for r in rows], [r[2] for r in rows], *([[r[3] for r in rows]] if names else []))


def bound_arrow_batches(spark: SparkSession) -> None:
    """Rows and bytes of an Arrow batch, so that a batch of texts stays a few megabytes on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def release_memory() -> None:
    """Give what a Python worker has freed back to the machine: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def frugal(run: Callable) -> Callable:
    """``run`` over the batches of a task, with the worker's free memory given back at its end."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return bounded


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices whose ``column`` holds at most ``limit`` bytes of text, or one row."""
    from lodestar.llm.words import pieces

    for batch in batches:
        for a, b in pieces(batch.column(column), limit):
            yield batch.slice(a, b - a)
