"""Training samples: no text is left out by its length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodestar.llm.common import held_out, spread, spread_sample
from lodestar.llm.toxicity import FIT_BYTES, FIT_ROWS, fit_toxicity, make_windows


def test_long_texts_are_learnt(spark):
    """Every toxic text is longer than 4 KB, and the sample is refilled from ids that have a text."""
    long = F.concat(F.lit("t"), "id", F.repeat(F.lit(" word"), 2000))
    text = F.when(F.col("id") % 3 == 0, long).when(F.col("id") % 3 == 1, F.concat(F.lit("c"), "id"))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    texts, y = spread_sample(docs, labels, "toxic", 50, FIT_BYTES)
    assert sorted(y) == [0] * 50 + [1] * 50 and {len(t) > 10_000 for t, c in zip(texts, y) if c} == {True}
    held = {r[0] for r in docs.filter(held_out(F.col("doc_id"))).select("text").collect()}
    assert not held & set(texts)
    less, z = spread_sample(docs, labels, "toxic", 50, 50 * 4096)
    assert y == z and max(len(t) for t in less) < 4200 and all(t.split()[0] in s for s, t in zip(texts, less))


def test_stretches_reach_the_whole_text():
    text = " ".join(f"é{i}" for i in range(20_000))
    part = spread(text, 8192)
    at = [int(w[1:]) for w in part.split() if w.startswith("é") and len(w) > 5]
    assert len(part.encode()) <= 8192 + 8 and text.startswith(part[:500]) and text.endswith(part[-500:])
    assert np.diff(sorted(at)).max() < 3500 and spread("short", 8) == "short"


def test_windows_made_in_portions_are_the_same():
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(rng.choice([f"w{i}" for i in range(90)], n)) for n in (5, 0, 300, 40, 1)] + [None])
    whole, parts = make_windows(texts), make_windows(texts, 50)
    for name in ("bucket", "grams", "gram_rows", "words", "rows"):
        assert (getattr(whole, name) == getattr(parts, name)).all(), name


def test_production_sample_on_the_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    texts, y = spread_sample(docs, labels, "toxic", FIT_ROWS, FIT_BYTES)
    assert max(len(t.encode()) for t in texts) > 1 << 12
    model = fit_toxicity(texts, y)
    rows = docs.join(labels, "doc_id").filter(held_out(F.col("doc_id"))).select("text", "toxic").collect()
    score = model.score(pa.array([r["text"] for r in rows]))
    right = ((score >= 0.5) == np.array([r["toxic"] for r in rows])).mean()
    print("accuracy", right, "texts", len(y), sum(y))
    assert right > 0.95


def test_quality_learns_from_a_text_of_100_kb(spark):
    from lodestar.llm.quality import FIT_BYTES as BYTES, FIT_ROWS as ROWS

    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat("id", F.repeat(F.lit(" word"), 20_000)).alias("text"))
    labels = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    texts, _ = spread_sample(docs, labels, "quality", ROWS, BYTES)
    assert len(texts) > 40 and min(len(t) for t in texts) > 100_000
