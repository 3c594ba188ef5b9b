"""One query per operator over the driver tables, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestar.llm import sql
from lodestar.llm.ann import build_index, search_index
from lodestar.llm.bpe import decode_documents, encode_documents, load_tokenizer
from lodestar.llm.common import held_out, shared_folder, spread_sample, table
from lodestar.llm.decontaminate import contamination
from lodestar.llm.hardneg import hard_negatives
from lodestar.llm.licenses import license_spans
from lodestar.llm.linededup import dedup_lines
from lodestar.llm.merkle import build_manifest, fold, proof_digest, row_digest
from lodestar.llm.neardup import near_duplicates
from lodestar.llm.quality import FIT_BYTES as QUALITY_BYTES, FIT_ROWS as QUALITY_ROWS, fit_quality, metadata_columns, quality_score
from lodestar.llm.secrets import KINDS, learn_formats, secret_spans
from lodestar.llm.tokencount import count_tokens
from lodestar.llm.toxicity import FIT_BYTES, FIT_ROWS as TOXIC_ROWS, fit_toxicity, toxicity_score
from lodestar.llm.warc import page_of, read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(*spread_sample(docs, table(spark, sf_dir, "labels"), "toxic", TOXIC_ROWS, FIT_BYTES))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    queries = vectors.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    return search_index(build_index(vectors, 5), queries, 5)


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_warc(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    stored = F.regexp_replace("payload_digest", "^sha256:", "")
    digest = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(stored)
    return read_warc(archives).select(
        page_of("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type",
        page_of("refers_to").alias("refers_to"),
    )


ORACLE["op3_warc"] = sql.ARCHIVE


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_spans(table(spark, sf_dir, "documents"))
    places = "array_join(transform(spans, s -> concat_ws(':', s.license, s.start, s.end)), ',')"
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.expr(places).alias("spans"))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, percent=85)


ORACLE["op6_near_duplicates"] = sql.NEAR_DUPLICATES


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = count_tokens(table(spark, sf_dir, "documents"), shared_folder(spark, "token-counts"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    metadata = metadata_columns(docs)
    model = fit_quality(*spread_sample(docs, table(spark, sf_dir, "labels"), "quality", QUALITY_ROWS, QUALITY_BYTES, metadata))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(model, F.col("text"), metadata).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def _joined_digest(items: Column) -> Column:
    """SHA-256 of the items as strings, sorted and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items.cast("array<string>")), ","), 256)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _joined_digest(F.col("items")).alias("items_sha256"), "contaminated",
    )


ORACLE["op9_decontamination"] = sql.CONTAMINATION


def _span_text(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_spans(docs, learn_formats(docs))
    base = f"filter(spans, s -> s.kind in {KINDS})"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.expr(f"sha2({_span_text(base)}, 256)").alias("base_sha256"), F.expr(_span_text("spans")).alias("spans")
    )


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = load_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = decode_documents(encode_documents(table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: The columns of a leaf, in their order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    tampered = F.when(changed, row_digest([*LEAF[:-1], lowered])).otherwise(row_digest(LEAF))
    manifest = build_manifest(docs, LEAF, "lang", ["doc_id"], [F.unhex(tampered).alias("tampered")])
    proved = manifest.proved().withColumn("folded_root", fold(F.lower(F.hex("kept.tampered"))))
    root = F.lit(manifest.root).cast("string")
    return proved.select(
        F.col("kept.doc_id").alias("doc_id"), "leaf", "subroot", root.alias("root"), proof_digest().alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )


ORACLE["op11_merkle_manifest"] = sql.MERKLE


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op12_line_dedup"] = sql.LINE_DEDUP


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = sql.HARD_NEGATIVES
