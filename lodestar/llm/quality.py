"""Quality classifier: a factorisation machine over words, structure and metadata.

A document becomes one row of hashed words (log counts, scaled to length one), one
active bin of every structure statistic, and one of every metadata column: numbers are binned by
quantiles, other values hashed, a null has a bin of its own. The pairwise interactions of all active
features come from low-rank factors in linear time by the identity
``sum_{i<j} <v_i, v_j> x_i x_j = ((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2``.

Defined cases: a null text scores as an empty one; an empty text has no words and the
lowest bins. Equal texts score alike wherever they are. With no training rows, or with
rows of one class only, every text takes the smoothed share of class 1 (0.5 for none).
Columns other than the text and the named metadata are not read, so clashing names do no harm;
ids, language, source and labels are refused as metadata.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodestar.llm.common import bound_arrow_batches
from lodestar.llm.words import PIECE_BYTES, SPACED, pieces, split_words

WORD_BUCKETS = 1 << 14
STAT_BINS = 16
#: Buckets of a hashed metadata column; one more stands for null.
META_BUCKETS = 64
#: Columns that a score may never depend on.
BARRED = ("doc_id", "lang", "source", "quality", "toxic")
FACTORS = 8
#: Labelled ids and bytes of text of each class the model is fitted on at most; beyond these bytes the longest texts are read in stretches.
FIT_ROWS, FIT_BYTES = 3000, 16 << 20

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = 1  # capitals
_KIND[97:123] = 2  # small letters
_KIND[48:58] = 3  # digits
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4  # signs
_KIND[128:] = 5  # beyond ASCII


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring offsets."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Features:
    """Sparse word features (``rows`` are offsets) and dense statistics."""

    bucket: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    stats: np.ndarray


def featurise(texts: pa.Array) -> Features:
    """Word and structure features of whole texts."""
    raw = split_words(texts, SPACED, lower=False)
    words = split_words(texts, SPACED)
    n = len(words.rows) - 1
    size = np.diff(words.offsets).astype(float)
    count = np.diff(words.rows).astype(float)
    kinds = _KIND[raw.data]
    share = [_sums((kinds == k).astype(np.float64), words.offsets) / np.maximum(size, 1) for k in range(1, 6)]
    lines = _sums((raw.data == 10).astype(np.float64), words.offsets)
    length = (words.end - words.start).astype(float)
    last = kinds[raw.end - 1] if len(raw.end) else kinds[:0]
    doubled = np.zeros(len(last))
    if len(last):
        doubled = (last == 4) & (kinds[np.maximum(raw.end - 2, 0)] == 4) & (length > 1)
    lone = (length == 1) & (last == 4)
    row = words.row_of()
    same = np.zeros(len(row))
    if len(row) > 1:
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (row[1:] == row[:-1])
    keys = (row.astype(np.uint64) << np.uint64(14)) | (words.hash >> np.uint64(50))
    unique, repeats = np.unique(keys, return_counts=True)
    rows = np.searchsorted(unique >> np.uint64(14), np.arange(n + 1).astype(np.uint64))
    value = np.log1p(repeats)
    norm = np.sqrt(_sums(value * value, rows))
    value = value / np.repeat(np.maximum(norm, 1e-9), np.diff(rows))
    per_word = np.maximum(count, 1)
    stats = np.stack(
        [
            np.log1p(size),
            np.log1p(count),
            *share,
            lines / per_word,
            _sums(length, words.rows) / per_word,
            _sums(doubled.astype(float), words.rows) / per_word,
            _sums(lone.astype(float), words.rows) / per_word,
            _sums((last == 4).astype(float), words.rows) / per_word,
            _sums(same, words.rows) / per_word,
            np.diff(rows) / per_word,
            norm / per_word,
        ],
        axis=1,
    )
    return Features((unique & np.uint64(WORD_BUCKETS - 1)).astype(np.int64), value.astype(np.float32), rows, stats)


def metadata_columns(docs: DataFrame, names: Sequence[str] = ("n_chars",)) -> list[Column]:
    """Those of ``names`` that ``docs`` has, numbers as doubles and anything else as text."""
    barred = [n for n in names if n.lower() in BARRED]
    if barred:
        raise ValueError(f"not to be learnt from: {barred}")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    return [
        F.col(f"`{n}`").cast("double" if isinstance(kinds[n], (T.NumericType, T.BooleanType)) else "string") for n in names if n in kinds
    ]


def _is_number(value: object) -> bool:
    return isinstance(value, (int, float)) and value == value


@dataclass
class MetaColumn:
    """Slots of one metadata column: bins between ``edges``, or hash buckets where there are none."""

    edges: np.ndarray | None

    @classmethod
    def of(cls, values: Sequence[object]) -> MetaColumn:
        numbers = [v for v in values if _is_number(v)]
        if not numbers:
            return cls(None)
        return cls(np.quantile(np.array(numbers, np.float64), np.linspace(0, 1, STAT_BINS + 1)[1:-1]) + 1e-12)

    def slots(self, values: Sequence[object]) -> np.ndarray:
        out = np.full(len(values), META_BUCKETS)
        for i, v in enumerate(values):
            if v is None or v != v:
                continue
            if self.edges is None:
                out[i] = zlib.crc32(str(v).encode()) % META_BUCKETS
            elif _is_number(v):
                out[i] = np.searchsorted(self.edges, v, "right")
        return out


@dataclass
class QualityModel:
    prior: float
    edges: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    linear: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS), np.float32))
    bias: float = 0.0
    metadata: list[MetaColumn] = field(default_factory=list)

    @property
    def constant(self) -> bool:
        return len(self.linear) == 0

    def joined(self, f: Features, metadata: Sequence[Sequence[object]] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature ids, values and row offsets with the bins of the statistics and of the metadata columns put in."""
        n, s = f.stats.shape
        bins = np.stack([np.searchsorted(self.edges[j], f.stats[:, j], "right") for j in range(s)], axis=1)
        ids = WORD_BUCKETS + np.arange(s) * STAT_BINS + bins
        base = WORD_BUCKETS + s * STAT_BINS
        slots = [base + j * (META_BUCKETS + 1) + c.slots(v) for j, (c, v) in enumerate(zip(self.metadata, metadata, strict=True))]
        ids = np.column_stack([ids, *slots])
        s = ids.shape[1]
        rows = f.rows + np.arange(n + 1) * s
        out, val = np.empty(rows[-1], np.int64), np.empty(rows[-1], np.float32)
        at = rows[:-1, None] + np.arange(s)
        out[at], val[at] = ids, 1 / np.sqrt(s)
        rest = np.ones(rows[-1], bool)
        rest[at] = False
        out[rest], val[rest] = f.bucket, f.value
        return out, val, rows

    def logits(self, ids: np.ndarray, val: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vx = self.factors[ids] * val[:, None]
        total = np.add.reduceat(vx, rows[:-1], axis=0)
        square = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), rows[:-1])
        line = np.add.reduceat(self.linear[ids] * val, rows[:-1])
        return self.bias + line + 0.5 * ((total * total).sum(axis=1) - square), total

    def score(self, texts: pa.Array, metadata: Sequence[Sequence[object]] = ()) -> np.ndarray:
        if self.constant:
            return np.full(len(texts), self.prior)
        out = np.empty(len(texts))
        for a, b in pieces(texts, PIECE_BYTES):
            z, _ = self.logits(*self.joined(featurise(texts.slice(a, b - a)), [m[a:b] for m in metadata]))
            out[a:b] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return out


def fit_quality(
    texts: list[str],
    labels: list[int],
    metadata: Sequence[tuple] = (),
    epochs: int = 12,
    rate: float = 0.08,
    l2: float = 1e-5,
    seed: int = 7,
) -> QualityModel:
    """Fit by AdaGrad on the logistic loss; classes weigh alike, which the bias undoes.

    ``metadata`` holds the values of the metadata columns of every text.
    """
    y = np.asarray(labels, dtype=np.float64)
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return QualityModel(float(prior))
    rng = np.random.default_rng(seed)
    parts = [featurise(pa.array([t], pa.large_string())) for t in texts]
    stats = np.concatenate([p.stats for p in parts])
    cuts = np.linspace(0, 1, STAT_BINS + 1)[1:-1]
    edges = np.quantile(stats, cuts, axis=0).T + 1e-12
    columns = [MetaColumn.of(values) for values in zip(*metadata)]
    size = WORD_BUCKETS + stats.shape[1] * STAT_BINS + len(columns) * (META_BUCKETS + 1)
    model = QualityModel(
        float(prior), edges, np.zeros(size, np.float32), rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32), metadata=columns
    )
    rows = [model.joined(p, [(v,) for v in m]) for p, m in zip(parts, metadata or [()] * len(parts))]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    g_lin, g_fac, g_bias = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 32):
            picked = order[at : at + 32]
            ids = np.concatenate([rows[i][0] for i in picked])
            val = np.concatenate([rows[i][1] for i in picked])
            offsets = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in picked])])
            z, total = model.logits(ids, val, offsets)
            d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[picked]) * weight[picked] / len(picked)
            each = np.repeat(d, np.diff(offsets))
            seen, where = np.unique(ids, return_inverse=True)
            lin = np.bincount(where, each * val, len(seen)) + l2 * model.linear[seen]
            slope = (each * val)[:, None] * (np.repeat(total, np.diff(offsets), axis=0) - model.factors[ids] * val[:, None])
            fac = np.stack([np.bincount(where, slope[:, k], len(seen)) for k in range(FACTORS)], axis=1) + l2 * model.factors[seen]
            g_lin[seen] += lin * lin
            g_fac[seen] += fac * fac
            g_bias += d.sum() ** 2
            model.linear[seen] -= (rate * lin / np.sqrt(g_lin[seen])).astype(np.float32)
            model.factors[seen] -= (rate * fac / np.sqrt(g_fac[seen])).astype(np.float32)
            model.bias -= rate * d.sum() / np.sqrt(g_bias)
    return model


def quality_score(model: QualityModel, text: Column, metadata: Sequence[Column] = ()) -> Column:
    """Probability of label 1 of every whole text; ``metadata`` are the columns the model was fitted on."""
    bound_arrow_batches(SparkSession.getActiveSession())
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for texts, *rest in parts:
            values = [c.astype(object).where(c.notna(), None).tolist() for c in rest]
            yield pd.Series(shared.value.score(pa.array(texts, pa.large_string(), from_pandas=True), values))

    # without metadata the texts would come without a tuple
    return score(text, *metadata) if model.metadata else _plain_score(shared, text)


def _plain_score(shared: Broadcast, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(shared.value.score(pa.array(texts, pa.large_string(), from_pandas=True)))

    return score(text)
