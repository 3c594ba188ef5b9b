"""Toxicity and quality: exact gradients and identities, odd rows, held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm.common import held_out, spread_sample
from lodestar.llm.quality import fit_quality, featurise, metadata_columns, quality_score
from lodestar.llm.toxicity import ToxicityModel, fit_toxicity, make_windows, toxicity_score
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, score int, held_out string"
ODD = [(1, "good plain words here"), (2, None), (3, ""), (None, "other text"), (1, "good plain words here"), (4, "long word " * 40_000)]


def made(rng, n):
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(20, 150)))
        if i % 3 == 0:
            for k in rng.integers(0, len(text), 3):
                text[k] = str(rng.choice(["vile", "rotten", f"scurr{rng.integers(100)}"]))
        texts.append(" ".join(text))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_windows_cover_every_word():
    text = " ".join(f"w{i}" for i in range(100))
    win = make_windows(pa.array([text, "", None, "a a a b"]))
    assert set(win.words[win.rows[0] : win.rows[1]].ravel()) - {-1} == set(win.words[win.words >= 0]) - set(win.words[win.rows[3] :].ravel())
    counts = np.diff(win.rows).tolist()
    assert counts == [6, 1, 1, 1] and (win.words[win.rows[3]] >= 0).sum() == 2


def test_network_gradients():
    win = make_windows(pa.array(["a bb ccc dd e", "", "foo bar baz " * 30]))
    model = ToxicityModel(1)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    y = np.zeros(len(win.words))
    y[0] = 1

    def loss():
        z = model.window_logits(win)
        return (np.log1p(np.exp(z)) - y * z).sum()

    grad = model.gradients(win, win.words, y, np.ones(len(y)))
    rng = np.random.default_rng(0)
    for name, g in grad.items():
        w = model.w[name]
        if isinstance(g, tuple):
            full = np.zeros(w.shape)
            np.add.at(full, g[0], g[1])
            at = (g[0][0], 0)
        else:
            full, at = np.asarray(g), tuple(rng.integers(0, s) for s in w.shape)
        old = w[at]
        w[at] = old + 1e-3
        up = loss()
        w[at] = old - 1e-3
        down = loss()
        w[at] = old
        assert (up - down) / 2e-3 == pytest.approx(full[at], rel=2e-2, abs=1e-4), name


def test_factorisation_identity():
    texts, labels = made(np.random.default_rng(1), 60)
    model = fit_quality(texts, labels, epochs=2)
    ids, val, rows = model.joined(featurise(pa.array(texts[:5])))
    z, _ = model.logits(ids, val, rows)
    for i in range(5):
        f, x = ids[rows[i] : rows[i + 1]], val[rows[i] : rows[i + 1]].astype(float)
        v = model.factors[f].astype(float)
        gram = (v @ v.T) * np.outer(x, x)
        plain = model.bias + model.linear[f] @ x + (gram.sum() - np.trace(gram)) / 2
        assert z[i] == pytest.approx(plain, rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("fit", [fit_toxicity, fit_quality])
def test_held_out_accuracy(fit):
    texts, labels = made(np.random.default_rng(2), 600)
    model = fit(texts[:450], labels[:450])
    score = model.score(pa.array(texts[450:]))
    assert ((score >= 0.5) == np.array(labels[450:])).mean() > 0.93


@pytest.mark.parametrize(("fit", "apply"), [(fit_toxicity, toxicity_score), (fit_quality, quality_score)])
def test_odd_rows_and_one_class(spark, fit, apply):
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in ODD], SCHEMA)
    texts, labels = made(np.random.default_rng(3), 60)
    for model in (fit(texts, labels), fit([], []), fit(["a"], [1])):
        got = frame.select("doc_id", "text", apply(model, F.col("text")).alias("s")).collect()
        assert all(0 <= r["s"] <= 1 for r in got) and len(got) == len(ODD)
        by = {r["text"]: r["s"] for r in got}
        assert by[None] == by[""] and len({r["s"] for r in got if r["doc_id"] == 1}) == 1
    assert fit([], []).score(pa.array(["x"])).tolist() == [0.5] and fit(["a"], [1]).score(pa.array(["x"]))[0] == pytest.approx(2 / 3)
    assert frame.limit(0).select(apply(fit([], []), F.col("text"))).isEmpty()


def test_sample_leaves_out_the_held_out_rows(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    odd = spark.createDataFrame([(None, 1), (8, 0), (12, None), (16, 1)], "doc_id long, toxic int")
    texts, y = spread_sample(docs, labels.unionByName(odd), "toxic", 30, 1 << 20)
    held = {f"t{r[0]}" for r in docs.filter(held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert sorted(y) == [0] * 30 + [1] * 30 and not held & set(texts) and "t8" not in texts and 50 < len(held) < 110


@pytest.mark.parametrize(("label", "fit"), [("toxic", fit_toxicity), ("quality", fit_quality)])
def test_accuracy_on_the_held_out_documents(spark, label, fit):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = fit(*spread_sample(docs, labels, label, 1000, 8 << 20))
    rows = docs.join(labels, "doc_id").filter(held_out(F.col("doc_id"))).select("text", label).collect()
    score = model.score(pa.array([r["text"] for r in rows]))
    assert ((score >= 0.5) == np.array([r[label] for r in rows])).mean() > 0.95


def test_metadata_takes_part_and_odd_values_have_bins(spark):
    rng = random.Random(12)
    rows = [(i, "the same words", rng.choice([None, 1, 5]) if i % 2 else rng.choice([90, 100]), "a" if i % 4 else None, i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, site string, quality int")
    labels = docs.select("doc_id", "quality")
    columns = metadata_columns(docs, ("n_chars", "site", "absent"))
    assert len(columns) == 2 and metadata_columns(docs) and not metadata_columns(labels)
    model = fit_quality(*spread_sample(docs, labels, "quality", 100, 1 << 20, columns))
    found = docs.select("quality", quality_score(model, F.col("text"), columns).alias("s")).collect()
    assert all((r["s"] >= 0.5) == (r["quality"] == 1) for r in found)
    odd = spark.createDataFrame([("", None, ""), (None, -5, "é"), ("x " * 50_000, 2**31 - 1, None)], "text string, n_chars int, site string")
    assert all(0 <= r[0] <= 1 for r in odd.select(quality_score(model, F.col("text"), metadata_columns(odd, ("n_chars", "site")))).collect())
    for name in ("lang", "source", "doc_id", "Quality"):
        with pytest.raises(ValueError, match="not to be learnt"):
            metadata_columns(docs, (name,))
