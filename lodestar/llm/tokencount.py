"""Token counts through a digest cache.

Every text has a content digest and every tokenizer a version digest. Counts are kept in
a Parquet cache under both. A run joins its digests to the cache, encodes one text of
each distinct digest that is missing, appends the counts, and joins them to all rows. So
copies are encoded once, and a second run over the same corpus encodes nothing.

Defined cases: a null text counts as an empty one (normalisation goes no further, as it
would change counts). Repeated rows give repeated results. A cache that does not exist
is created; rows that two runs have both appended count once. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestar.llm.common import bound_arrow_batches, slices

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer's file and of the version of the library that reads it."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    digest = hashlib.sha256(library.__version__.encode())
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


@lru_cache(maxsize=2)
def _counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counting function of a tokenizer file, loaded once in each worker."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]


def _encode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in slices(batches, 32):
            counts = count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The cache, created when there is none."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException:
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def count_tokens(docs: DataFrame, cache: str, path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every document; ``cache`` is a folder all executors share."""
    bound_arrow_batches(docs.sparkSession)
    spark, version = docs.sparkSession, tokenizer_digest(path)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("content", F.sha2("text", 256))

    def known() -> DataFrame:
        return read_cache(spark, cache).filter(F.col("tokenizer") == version).dropDuplicates(["content"]).select("content", "n_tokens")

    # copies meet before the shuffle: one text per digest and task travels
    distinct = rows.groupBy("content").agg(F.first("text").alias("text"))
    missing = distinct.join(known().select("content"), "content", "left_anti")
    counted = missing.mapInArrow(_encode(path), "content string, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content")
    return sizes.join(known(), "content").select("doc_id", "n_bytes", "n_tokens")
