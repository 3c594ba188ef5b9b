"""Toxicity: a bidirectional gated recurrent network over windows of words.

A word enters as the sum of its own embedding and those of its characters: its character
trigrams and its beginnings. Both directions read a window; attention weighs the states of all
its words into one vector, and that gives the window's score. Windows overlap by half
and cover the whole text, whose score is that of its most toxic window.

Training is plain numpy. A labelled text does not say which window is toxic, so each
text learns by one window: first the one with the most telling words, later the one
that the network itself scores highest. Embeddings start from how telling a word or its
parts are.

Defined cases: a null text scores as an empty one, which is a window without words and
gets the score of the network's bias. Equal texts score alike. With no training rows,
or rows of one class only, every text has the smoothed share of class 1. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

from lodestar.llm.common import bound_arrow_batches
from lodestar.llm.words import ALNUM, PIECE_BYTES, hash_spans, mix, pieces, split_words

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BITS, PREFIX_BYTES = 1 << 14, 15, 8
WORD_DIM, HIDDEN = 12, 8
#: Labelled ids of each class the network is fitted on at most, and bytes of all their texts.
FIT_ROWS, FIT_BYTES = 1500, 1500 << 13
#: Distinct words whose parts are gathered together, and windows whose parts are counted together (or one text).
WORDS_AT_ONCE, WINDOWS_AT_ONCE = 1 << 13, 1 << 12
#: Windows that run through the network together.
BATCH = 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Windows:
    """Distinct words with their trigrams and beginnings, and windows of word numbers (-1: no word)."""

    bucket: np.ndarray
    grams: np.ndarray
    gram_rows: np.ndarray
    words: np.ndarray
    rows: np.ndarray
    keys: np.ndarray


def make_windows(texts: pa.Array, limit: int = PIECE_BYTES) -> Windows:
    """All windows of whole texts, made from ``limit`` bytes (or one text) at a time.

    A text without words has one empty window. A word repeated in a row counts once, so
    that such a row fills no window.
    """
    parts = [_piece_windows(texts.slice(a, b - a)) for a, b in pieces(texts, limit)]
    if len(parts) < 2:
        return parts[0] if parts else _piece_windows(texts)
    all_keys = np.concatenate([p.keys for p in parts])
    keys, first = np.unique(all_keys, return_index=True)
    lengths = np.concatenate([np.diff(p.gram_rows) for p in parts])
    starts = np.cumsum(lengths) - lengths
    grams = np.concatenate([p.grams for p in parts])[_ragged(starts[first], lengths[first])]
    gram_rows = np.concatenate([[0], np.cumsum(lengths[first])])
    words = np.concatenate([np.append(np.searchsorted(keys, p.keys), -1).astype(np.int32)[p.words] for p in parts])
    rows = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.rows) for p in parts]))])
    return Windows(np.concatenate([p.bucket for p in parts])[first], grams, gram_rows, words, rows, keys)


def _piece_windows(texts: pa.Array) -> Windows:
    w = split_words(texts, ALNUM)
    fresh = np.ones(len(w.start), bool)
    if len(fresh):
        fresh[1:] = w.hash[1:] != w.hash[:-1]
        fresh[w.rows[:-1][np.diff(w.rows) > 0]] = True
    w.start, w.end, w.hash = w.start[fresh], w.end[fresh], w.hash[fresh]
    w.rows = np.concatenate([[0], np.cumsum(fresh)])[w.rows]
    keys, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
    start, length = w.start[first], (w.end - w.start)[first]
    at, owner_start, owner_end = _ragged(start, length), np.repeat(start, length), np.repeat(start + length, length)
    data = w.data.astype(np.uint64)
    before = np.where(at > owner_start, data[np.maximum(at - 1, 0)], 0) if len(at) else data[:0]
    after = np.where(at + 1 < owner_end, data[np.minimum(at + 1, len(data) - 1)], 0) if len(at) else data[:0]
    grams = [mix(before | (data[at] << np.uint64(8)) | (after << np.uint64(16)))]
    owner = [np.repeat(np.arange(len(keys)), length)]
    for k in range(2, PREFIX_BYTES + 1):
        own = np.flatnonzero(length >= k)
        grams.append(mix(hash_spans(w.data, start[own], start[own] + k)))
        owner.append(own)
    grams, owner = np.concatenate(grams) >> np.uint64(64 - GRAM_BITS), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    gram_rows = np.searchsorted(owner[order], np.arange(len(keys) + 1))
    count = np.diff(w.rows)
    made = 1 + np.maximum(0, -((WINDOW - count) // STRIDE))
    rows = np.concatenate([[0], np.cumsum(made)])
    row = np.repeat(np.arange(len(count)), made)
    begin = w.rows[:-1][row] + (np.arange(rows[-1]) - rows[row]) * STRIDE
    place = begin[:, None] + np.arange(WINDOW)
    inside = place < w.rows[1:][row][:, None]
    words = np.full(place.shape, -1, np.int32)
    words[inside] = which[place[inside]]
    return Windows((keys >> np.uint64(50)).astype(np.int64), grams[order].astype(np.int64), gram_rows, words, rows, keys)


class ToxicityModel:
    """Weights of the network; ``constant`` stands in for it when there is nothing to learn."""

    def __init__(self, seed: int = 5, constant: float | None = None) -> None:
        rng = np.random.default_rng(seed)

        def normal(scale: float, *shape: int) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        h = HIDDEN
        self.constant = constant
        self.w: dict[str, np.ndarray] = {
            "word": normal(0.05, WORD_BUCKETS, WORD_DIM),
            "gram": normal(0.05, 1 << GRAM_BITS, WORD_DIM),
            "att": normal(0.3, 2 * h, h),
            "att_b": np.zeros(h, np.float32),
            "att_v": normal(0.3, h),
            "out": normal(0.3, 2 * h),
            "bias": np.full(1, -1.0, np.float32),
        }
        for side in "fb":
            self.w[f"in_{side}"] = normal(0.3, WORD_DIM, 3 * h)
            self.w[f"in_b_{side}"] = np.zeros(3 * h, np.float32)
            self.w[f"rec_{side}"] = normal(0.3, h, 3 * h)

    def inputs(self, win: Windows, words: np.ndarray) -> np.ndarray:
        """Input vectors of the named words."""
        out = self.w["word"][win.bucket[words]]
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            length = np.diff(win.gram_rows)[part]
            grams = self.w["gram"][win.grams[_ragged(win.gram_rows[part], length)]]
            char = np.add.reduceat(grams, np.cumsum(length) - length, axis=0)
            out[at : at + WORDS_AT_ONCE] += char / np.sqrt(length, dtype=np.float32)[:, None]
        return out

    def run(self, table: dict[str, np.ndarray], words: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows; ``table`` has the gate inputs of every word, the last row for none."""
        h, n = HIDDEN, len(words)
        mask = words >= 0
        states = np.zeros((WINDOW, n, 2 * h), np.float32)
        steps: dict = {"f": [], "b": []}
        for k, side in enumerate("fb"):
            state = np.zeros((n, h), np.float32)
            rec = self.w[f"rec_{side}"]
            for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
                g, a = table[side][words[:, t]], state @ rec
                zr = _sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(g[:, 2 * h :] + r * a[:, 2 * h :])
                m = mask[:, t, None]
                after = np.where(m, new + z * (state - new), state)
                if keep:
                    steps[side].append((t, state, z, r, new, a[:, 2 * h :], m))
                state = after
                states[t, :, k * h : (k + 1) * h] = state
        q = np.tanh(states @ self.w["att"] + self.w["att_b"])
        e = np.where(mask.T, q @ self.w["att_v"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        e = np.where(mask.T, e, 0)
        alpha = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", alpha, states)
        logit = pooled @ self.w["out"] + self.w["bias"][0]
        return logit, {"steps": steps, "states": states, "q": q, "alpha": alpha, "pooled": pooled} if keep else {}

    def gate_table(self, x: np.ndarray) -> dict[str, np.ndarray]:
        x = np.concatenate([x, np.zeros((1, WORD_DIM), np.float32)])
        return {s: x @ self.w[f"in_{s}"] + self.w[f"in_b_{s}"] for s in "fb"}

    def window_logits(self, win: Windows) -> np.ndarray:
        table = self.gate_table(self.inputs(win, np.arange(len(win.bucket))))
        parts = [self.run(table, win.words[a : a + BATCH])[0] for a in range(0, len(win.words), BATCH)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Score of every text: that of its most toxic window."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        out = np.empty(len(texts))
        for a, b in pieces(texts):
            win = make_windows(texts.slice(a, b - a))
            best = np.maximum.reduceat(self.window_logits(win), win.rows[:-1])
            out[a:b] = 1 / (1 + np.exp(-np.clip(best.astype(np.float64), -40, 40)))
        return out

    def gradients(self, win: Windows, words: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the weighted logistic loss of windows; embeddings as (rows, values)."""
        h = HIDDEN
        used, local = np.unique(words[words >= 0], return_inverse=True)
        own = np.full(words.shape, -1)
        own[words >= 0] = local
        x = self.inputs(win, used)
        logit, kept = self.run(self.gate_table(x), own, keep=True)
        d = ((1 / (1 + np.exp(-logit)) - y) * weight).astype(np.float32)
        states, q, alpha = kept["states"], kept["q"], kept["alpha"]
        grad: dict = {"out": kept["pooled"].T @ d, "bias": np.array([d.sum()])}
        d_pool = d[:, None] * self.w["out"]
        d_alpha = np.einsum("nh,tnh->tn", d_pool, states)
        d_states = alpha[:, :, None] * d_pool
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        d_q = d_e[:, :, None] * self.w["att_v"] * (1 - q * q)
        grad["att_v"] = np.einsum("tn,tnh->h", d_e, q)
        grad["att"] = np.einsum("tnk,tnh->kh", states, d_q)
        grad["att_b"] = d_q.sum(axis=(0, 1))
        d_states += d_q @ self.w["att"].T
        d_x = np.zeros((len(used) + 1, WORD_DIM), np.float32)
        for k, side in enumerate("fb"):
            rec, d_rec = self.w[f"rec_{side}"], np.zeros((h, 3 * h), np.float32)
            d_gate = np.zeros((len(used) + 1, 3 * h), np.float32)
            carry = np.zeros((len(words), h), np.float32)
            for t, state, z, r, new, a_new, m in reversed(kept["steps"][side]):
                total = d_states[t, :, k * h : (k + 1) * h] + carry
                dh = np.where(m, total, 0)
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (state - new) * z * (1 - z)
                dr = dn * a_new * r * (1 - r)
                da = np.concatenate([dz, dr, dn * r], axis=1)
                d_rec += state.T @ da
                carry = np.where(m, dh * z + da @ rec.T, total)
                np.add.at(d_gate, own[:, t], np.concatenate([dz, dr, dn], axis=1))
            d_gate = d_gate[:-1]
            grad[f"rec_{side}"], grad[f"in_{side}"] = d_rec, x.T @ d_gate
            grad[f"in_b_{side}"] = d_gate.sum(axis=0)
            d_x[:-1] += d_gate @ self.w[f"in_{side}"].T
        d_x = d_x[:-1]
        length = np.diff(win.gram_rows)[used]
        grad["word"] = (win.bucket[used], d_x)
        spread = np.repeat(d_x / np.sqrt(length, dtype=np.float32)[:, None], length, axis=0)
        grad["gram"] = (win.grams[_ragged(win.gram_rows[used], length)], spread)
        return grad


class _Adagrad:
    def __init__(self, model: ToxicityModel, rate: float) -> None:
        self.model, self.rate = model, rate
        self.seen = {k: np.full(v.shape, 1e-4, np.float32) for k, v in model.w.items()}

    def step(self, grad: dict) -> None:
        for name, g in grad.items():
            w, seen = self.model.w[name], self.seen[name]
            if isinstance(g, tuple):
                rows, where = np.unique(g[0], return_inverse=True)
                total = np.zeros((len(rows), w.shape[1]), np.float32)
                np.add.at(total, where, g[1])
                seen[rows] += total * total
                w[rows] -= self.rate * total / np.sqrt(seen[rows])
            else:
                seen += np.asarray(g, np.float32) ** 2
                w -= self.rate * np.asarray(g, np.float32) / np.sqrt(seen)


def _telling(win: Windows, y: np.ndarray, doubt: float = 6.0) -> tuple[np.ndarray, np.ndarray]:
    """How much a distinct word, and a trigram or beginning, speaks for class 1.

    Log odds of the class among the texts that hold it over those of all texts, 0 at
    least; ``doubt`` texts of the usual mixture are added to each count.
    """
    length, n, parts = np.diff(win.gram_rows), len(win.bucket), 1 << GRAM_BITS
    counts = {size: np.zeros((2, size)) for size in (n, parts)}
    at = 0
    while at < len(y):
        upto = max(at + 1, int(np.searchsorted(win.rows, win.rows[at] + WINDOWS_AT_ONCE, "right")) - 1)
        labels, rows = y[at:upto], win.rows[at : upto + 1]
        at = upto
        text = np.repeat(np.repeat(np.arange(len(labels)), np.diff(rows)), WINDOW)
        word = win.words[rows[0] : rows[-1]].reshape(-1)
        text, word = np.divmod(np.unique(text[word >= 0] * n + word[word >= 0]), n)
        grams = win.grams[_ragged(win.gram_rows[word], length[word])]
        of, gram = np.divmod(np.unique(np.repeat(text, length[word]) * parts + grams), parts)
        for size, owner, part in ((n, text, word), (parts, of, gram)):
            counts[size][0] += np.bincount(part, labels[owner], size)
            counts[size][1] += np.bincount(part, 1 - labels[owner], size)
    share = y.mean()

    def ratio(one: np.ndarray, none: np.ndarray) -> np.ndarray:
        odds = (one + doubt * share) / (none + doubt * (1 - share))
        return np.maximum(0, np.log(odds) - np.log(share / (1 - share)))

    return ratio(*counts[n]), ratio(*counts[parts])


def fit_toxicity(texts: list[str], labels: list[int], steps: int = 500, batch: int = 48, rate: float = 0.03, seed: int = 5) -> ToxicityModel:
    """Train on texts with labels 0 and 1; half of every batch is of class 1."""
    y = np.asarray(labels, dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        return ToxicityModel(constant=float((y.sum() + 1) / (len(y) + 2)))
    rng = np.random.default_rng(seed)
    win = make_windows(pa.array(texts, pa.large_string()))
    model = ToxicityModel(seed)
    optimiser = _Adagrad(model, rate)
    by_word, by_gram = _telling(win, y)
    telling = np.append(np.maximum(by_word, np.maximum.reduceat(by_gram[win.grams], win.gram_rows[:-1])), 0.0)
    model.w["word"][win.bucket, 0] = by_word
    model.w["gram"][:, 0] = by_gram
    parts = range(0, len(win.words), BATCH)
    rank = np.concatenate([np.sort(telling[win.words[a : a + BATCH]], axis=1)[:, -3:].sum(axis=1) for a in parts])
    groups = [np.flatnonzero(y == c) for c in (0, 1)]

    def best() -> np.ndarray:
        return np.array([a + int(np.argmax(rank[a:b])) for a, b in zip(win.rows[:-1], win.rows[1:])])

    chosen = best()
    for step in range(steps):
        if step in (steps // 3, 2 * steps // 3):
            rank = model.window_logits(win)
            chosen = best()
        zeros = rng.choice(groups[0], batch // 2)
        ones = rng.choice(groups[1], batch // 2)
        # of a text of class 0 every window is one of class 0: its worst and any other
        any_window = win.rows[zeros] + (rng.random(len(zeros)) * np.diff(win.rows)[zeros]).astype(int)
        picked = np.concatenate([chosen[zeros], any_window, chosen[ones]])
        target = np.concatenate([np.zeros(2 * len(zeros)), np.ones(len(ones))])
        weight = np.concatenate([np.full(2 * len(zeros), 0.5), np.ones(len(ones))]) / batch
        words = win.words[picked].copy()
        words[(rng.random(words.shape) < 0.1) & (telling[words] < 1)] = -1  # rarely rely on one ordinary word
        optimiser.step(model.gradients(win, words, target, weight))
    return model


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score of every whole text, between 0 and 1."""
    bound_arrow_batches(SparkSession.getActiveSession())
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(shared.value.score(pa.array(texts, pa.large_string(), from_pandas=True)))

    return score(text)
