"""Byte-level BPE against the tiktoken library, and exact round trips."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from lodestar.llm.bpe import PerfectHash, Tokenizer, decode_documents, encode_documents, load_tokenizer, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "é", "中文", "!", "?", "1", "²", "a", "B", " ", "　", "x'",
          "😀", "́", "'S", "\r\n", "<|endoftext|>", "ſ", "٣", "hello", " world", "\x00", "\x1c"]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def tokenizer(ranks):
    return Tokenizer(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    assert sorted(PerfectHash(keys).slots(keys).tolist()) == list(range(len(keys)))
    one = np.array([5], np.uint64)
    assert PerfectHash(one).slots(one).tolist() == [0]


def test_random_texts(tokenizer, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(8000)]
    ids, rows = tokenizer.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[rows[i] : rows[i + 1]].tolist() == library.encode_ordinary(text), repr(text)
    data, offsets = tokenizer.decode(ids, rows)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])] == texts


def test_long_pretoken(tokenizer, library):
    for text in ("a" * 40_001, "ab" * 9_000, "=" * 20_000):
        assert tokenizer.encode(pa.array([text]))[0].tolist() == library.encode_ordinary(text)


def test_memo_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr("lodestar.llm.bpe.MEMO_ENTRIES", 50)
    other = Tokenizer(tokenizer.ranks)
    for k in range(30):
        other.merged([f"zq{k}x{i}".encode() for i in range(20)])
    assert len(other.memo) <= 70


def test_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = [(None, None), (1, ""), (2, None), (None, "two  words"), (3, "x" * 30_000)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).selectExpr("*", "1 as ids", "'a' as decoded")
    shared = load_tokenizer(spark, PATH)
    got = decode_documents(encode_documents(docs, shared), shared).collect()
    want = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"]).decode(), r["ids"]) for r in got) == sorted(
        (repr(i), t, library.encode_ordinary(t)) for i, t in want
    )
    assert encode_documents(docs.limit(0), shared).isEmpty()


def test_odd_ids(spark, tokenizer):
    shared = spark.sparkContext.broadcast(tokenizer)
    frame = spark.createDataFrame([(1, None), (2, []), (3, [None, 64, None]), (4, [-1, 10**6])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in decode_documents(frame, shared).collect()}
    hello = tokenizer.decode(np.array([64]), np.array([0, 1]))[0].tobytes()
    assert got == {1: None, 2: b"", 3: hello, 4: "��".encode()}
