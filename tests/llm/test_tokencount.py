"""Token counts against the libraries, and what the cache saves."""

from __future__ import annotations

import public_tokenizers
import pytest

from lodestar.llm.tokencount import _counter, count_tokens, read_cache

SCHEMA = "doc_id long, text string, content string, n_tokens string"
TEXTS = ["hello world", "  a  b\n", "", None, "hello world", "<|endoftext|> x", "naïve 中文 😀", "word " * 20_000]


def library(path, text):
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    from sentencepiece import SentencePieceProcessor

    return len(SentencePieceProcessor(model_file=path).encode(text))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_and_cache(spark, tmp_path, monkeypatch, name):
    path, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    data = [(i, t, "c", "n") for i, t in enumerate(TEXTS)] + [(None, "hello world", None, None), (0, "hello world", None, None)]
    frame = spark.createDataFrame(data, SCHEMA)
    want = sorted((repr(i), len((t or "").encode()), library(path, t or "")) for i, t, _, _ in data)

    def got(f):
        return sorted((repr(r[0]), r[1], r[2]) for r in count_tokens(f, cache, path).collect())

    assert got(frame) == want
    assert read_cache(spark, cache).count() == len({t or "" for t in TEXTS})
    more = frame.unionByName(spark.createDataFrame([(50, "new text", None, None)], SCHEMA))
    assert len(got(more)) == len(data) + 1
    assert read_cache(spark, cache).count() == len({t or "" for t in TEXTS}) + 1
    other = public_tokenizers.path("byte_bpe_50k.json" if "json" not in name else "piece_bpe_32k.model")
    count_tokens(frame, cache, other)
    assert read_cache(spark, cache).select("tokenizer").distinct().count() == 2
    # rows that two runs have both appended
    read_cache(spark, cache).write.mode("append").parquet(str(tmp_path / "twice"))
    read_cache(spark, cache).write.mode("append").parquet(str(tmp_path / "twice"))
    assert sorted((repr(r[0]), r[1], r[2]) for r in count_tokens(frame, str(tmp_path / "twice"), path).collect()) == want


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    out = count_tokens(frame, str(tmp_path / "cache"), public_tokenizers.path("byte_bpe_50k.json"))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens"] and out.isEmpty()


def test_loaded_once():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert _counter(path) is _counter(path)
