"""The pipeline's stages against brute force, and what the entry registers."""

from __future__ import annotations

import hashlib
import shutil

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_windows
from test_neardup import brute as brute_groups

from __spark_entry__ import oracle_sql, queries
from lodestar.llm.bpe import read_ranks
from lodestar.llm.common import spread_sample
from lodestar.llm.quality import FIT_BYTES, FIT_ROWS, fit_quality, metadata_columns
from lodestar.llm.secrets import all_spans, learn_formats, redact

FOLDER = "/root/testdata/sf0.001"


def test_registered_queries():
    names = queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "token_ids"]
    assert {"op3_warc", "op6_near_duplicates", "op9_decontamination"} <= oracle_sql().keys() and "pipeline" not in oracle_sql()


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{FOLDER}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = by_id(docs)
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        after = by_id(out)
        ids = sorted(before)
        if name == "quality":
            model = fit_quality(*spread_sample(docs, labels, "quality", FIT_ROWS, FIT_BYTES, metadata_columns(docs)))
            score = model.score(pa.array([before[i]["text"] for i in ids]), [[before[i]["n_chars"] for i in ids]])
            assert sorted(after) == [i for i, s in zip(ids, score) if s >= 0.3] and len(after) > 0.7 * len(before)
        elif name == "near_dedup":
            assert sorted(after) == [r[0] for r in brute_groups([(i, before[i]["text"]) for i in ids], 5, 80) if r[3]]
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            assert sorted(after) == sorted(r[0] for r in brute_windows([(i, before[i]["text"]) for i in ids], bench, 10) if not r[4])
        elif name == "secrets":
            model = learn_formats(docs)
            want = {i: redact(r["text"], all_spans(r["text"], model)) for i, r in before.items()}
            assert {i: r["text"] for i, r in after.items()} == want
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        else:
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                        mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
            assert {i: r["ids"] for i, r in after.items()} == {i: library.encode_ordinary(r["text"]) for i, r in before.items()}
            assert all(r["decoded_sha256"] == hashlib.sha256(before[i]["text"].encode()).hexdigest() for i, r in after.items())
        if name != "token_ids":
            assert out.columns == columns
        docs = out


@pytest.mark.parametrize("empty", [False, True])
def test_run_over_odd_tables(spark, tmp_path, empty):
    for table in ("labels", "benchmark"):
        shutil.copy(f"{FOLDER}/{table}.parquet", tmp_path / f"{table}.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (3, "x " * 60_000, "en", "s", 1)]
    docs = spark.createDataFrame([] if empty else rows, schema).withColumn("score", F.lit(1)).withColumn("spans", F.lit("s"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = {r["doc_id"] for r in out.collect()}
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and got <= {1, 2, None, 3} and (not empty or not got)
