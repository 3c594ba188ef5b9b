"""SuperMinHash signatures of many ragged sets at once.

Every element draws a random permutation of the signature's positions, one step at a
time, and offers at step j the value ``j + u`` to the j-th position of its permutation.
A step is taken for all elements of all sets together. Values of step j lie in
[j, j + 1), so a set whose largest value is below j is finished: its further steps can
change nothing. Large sets end after a step or two, small ones after a few.
"""

from __future__ import annotations

import numpy as np

from lodestar.llm.words import mix

_STREAM = 0x9E3779B97F4A7C15
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Cells of the permutations kept at a time.
STATE_CELLS = 1 << 21


def _step(seeds: np.ndarray, j: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Value and swap partner of step j."""
    x = mix(seeds + np.uint64(_STREAM * (j + 1) % (1 << 64)))
    value = (np.uint64(j) << np.uint64(32)) | (x >> np.uint64(32))
    other = np.uint64(j) + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))
    return value, other.astype(np.int64)


def _rest(elements: np.ndarray, owner: np.ndarray, sig: np.ndarray) -> None:
    """Steps from 1 on for the elements of sets that are not finished."""
    m = sig.shape[1]
    perm = np.tile(np.arange(m, dtype=np.int16), (len(elements), 1))
    _, other = _step(elements, 0, m)
    at = np.arange(len(elements))
    perm[at, 0], perm[at, other] = other, 0
    for j in range(1, m):
        open_sets = sig.max(axis=1) >= np.uint64(j << 32)
        on = open_sets[owner]
        if not on.all():
            elements, owner, perm = elements[on], owner[on], perm[on]
            at = np.arange(len(elements))
        if not len(elements):
            return
        value, other = _step(elements, j, m)
        kept = perm[at, other].copy()
        perm[at, other] = perm[at, j]
        perm[at, j] = kept
        np.minimum.at(sig.reshape(-1), owner * m + kept, value)


def signatures(elements: np.ndarray, rows: np.ndarray, m: int) -> np.ndarray:
    """One row of ``m`` values per set ``elements[rows[i]:rows[i + 1]]``; empty sets keep the top value."""
    n = len(rows) - 1
    sig = np.full((n, m), _EMPTY, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(rows))
    value, other = _step(elements, 0, m)
    np.minimum.at(sig.reshape(-1), owner * m + other, value)
    size = np.diff(rows)
    open_sets = np.flatnonzero((size > 0) & (sig.max(axis=1) >= np.uint64(1 << 32)))
    group = np.cumsum(size[open_sets]) // max(1, STATE_CELLS // m)
    for g in np.unique(group):
        sets = open_sets[group == g]
        picked = np.concatenate([np.arange(rows[i], rows[i + 1]) for i in sets])
        part = sig[sets]
        _rest(elements[picked], np.repeat(np.arange(len(sets)), size[sets]), part)
        sig[sets] = part
    return sig
