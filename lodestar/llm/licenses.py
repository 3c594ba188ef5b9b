"""License scans: MinHash bands over overlapping windows, verified by exact containment.

Templates are grouped by length. For each group the text is read in overlapping windows,
long enough and dense enough that every occurrence of a template lies whole inside one.
From the least similarity that such a window then has with its template follows how many
bands make a miss rarer than ``MISS``. A band holds one MinHash value, so a window without
any shingle of a template can meet none, and is not hashed at all. What the bands retrieve
is verified on the shingles themselves: a template is found where a stretch of its length
holds at least ``CONTAINED`` of its distinct shingles.

Defined cases: null, empty and short texts have no license. Where matches overlap, the
one with the larger contained share stays, then the longer one, then the first by name.
Repeated rows give repeated results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestar.llm.common import bound_arrow_batches, small_batches
from lodestar.llm.words import ALNUM, Words, mix, ngram_hashes, split_words

SHINGLE_WORDS, CONTAINED, MISS = 5, 0.8, 1e-6
_FILTER_BITS = 20

#: Usual license notices, by SPDX identifier and a number for each wording.
TEMPLATES = {
    "Apache-2.0/1": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/2": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD/1": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "CC-BY-4.0/1": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0/1": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0/1": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0/2": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-2.0/1": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/1": "This work is licensed under the GNU General Public License, version 3.",
    "GPL/1": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "MIT/1": "Released under the MIT License.",
    "MIT/2": "Licensed under the MIT License.",
    "MIT/3": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "MPL-2.0/1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


@dataclass
class Group:
    """Templates of like length, their windows and bands."""

    window: int
    stride: int
    seeds: np.ndarray
    table: dict[tuple[int, int], list[int]]


@dataclass
class LicenseIndex:
    names: list[str]
    words: list[int]
    shingles: list[np.ndarray]
    groups: list[Group]
    known: np.ndarray
    present: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """True for shingles of any template."""
        out = self.present[hashes >> np.uint64(64 - _FILTER_BITS)]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        out[at] = self.known[place] == hashes[at]
        return out


def _minima(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    return mix(shingles[None, :] ^ seeds[:, None]).min(axis=1)


def bands_needed(similarity: float, miss: float = MISS) -> int:
    """Bands of one value that miss a pair of this similarity with probability ``miss`` at most."""
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log(1 - similarity))


def build_licenses(templates: Mapping[str, str] = TEMPLATES) -> LicenseIndex:
    """Index of license templates; each needs the words of a shingle."""
    names = sorted(templates)
    words = split_words(pa.array([templates[n] for n in names], pa.large_string()), ALNUM)
    sizes = np.diff(words.rows).tolist()
    if names and min(sizes) < SHINGLE_WORDS:
        raise ValueError(f"a license template needs {SHINGLE_WORDS} words")
    hashes, rows = ngram_hashes(words, SHINGLE_WORDS)
    shingles = [np.unique(hashes[a:b]) for a, b in zip(rows[:-1], rows[1:])]
    lengths: dict[int, list[int]] = {}
    for i, n in enumerate(sizes):
        lengths.setdefault(SHINGLE_WORDS if n == SHINGLE_WORDS else 1 << (n - 1).bit_length(), []).append(i)
    groups = []
    for longest, members in sorted(lengths.items()):
        stride = max(1, longest // 2)
        window = longest + stride - 1 - (SHINGLE_WORDS - 1)  # in shingles
        need = [math.ceil(CONTAINED * len(shingles[i])) for i in members]
        least = min(k / (window + len(shingles[i]) - k) for k, i in zip(need, members))
        bands = bands_needed(least)
        seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(longest))
        table: dict[tuple[int, int], list[int]] = {}
        for i in members:
            for band, value in enumerate(_minima(shingles[i], seeds).tolist()):
                table.setdefault((band, value), []).append(i)
        groups.append(Group(window, stride, seeds, table))
    known = np.unique(np.concatenate(shingles)) if names else np.zeros(1, np.uint64)
    present = np.zeros(1 << _FILTER_BITS, bool)
    present[known >> np.uint64(64 - _FILTER_BITS)] = bool(names)
    return LicenseIndex(names, sizes, shingles, groups, known, present)


def _contained(part: np.ndarray, template: np.ndarray, words: int) -> Iterator[tuple[float, int, int]]:
    """Stretches as long as the template that hold enough of its shingles: share, first and end word."""
    places = np.flatnonzero(np.isin(part, template))
    for j, first in enumerate(places.tolist()):
        own = places[j : np.searchsorted(places, first + words - SHINGLE_WORDS + 1)]
        share = len(np.unique(part[own])) / len(template)
        if share >= CONTAINED:
            yield share, first, int(own[-1]) + SHINGLE_WORDS


def scan(words: Words, index: LicenseIndex) -> list[tuple[int, str, int, int, float]]:
    """Row, license, first word, end word and contained share of every match."""
    hashes, rows = ngram_hashes(words, SHINGLE_WORDS)
    marked = np.flatnonzero(index.holds(hashes)) if len(hashes) else np.zeros(0, np.int64)
    found: dict[int, set[tuple[float, int, str, int, int]]] = {}
    for group in index.groups:
        if not len(marked):
            break
        row = np.searchsorted(rows, marked, "right") - 1
        local = marked - rows[row]
        # the windows that hold a marked shingle: numbers last - k down to the first one
        last = local // group.stride
        spread = np.arange(-(-group.window // group.stride))
        number = last[:, None] - spread
        held = (number >= 0) & (number * group.stride + group.window > local[:, None])
        windows = np.unique(np.stack([np.repeat(row, len(spread))[held.ravel()], number[held]], axis=1), axis=0)
        for r, w in windows.tolist():
            start = int(rows[r]) + w * group.stride
            part = hashes[start : min(start + group.window, int(rows[r + 1]))]
            distinct = np.unique(part)
            hits = {i for key in enumerate(_minima(distinct, group.seeds).tolist()) for i in group.table.get(key, ())}
            for i in hits:
                for share, first, end in _contained(part, index.shingles[i], index.words[i]):
                    at = w * group.stride + first
                    stop = min(w * group.stride + end, int(words.rows[r + 1] - words.rows[r]))
                    found.setdefault(r, set()).add((-share, -(stop - at), index.names[i], at, stop))
    out = []
    for r in sorted(found):
        taken: list[tuple[int, int]] = []
        for share, _, name, first, end in sorted(found[r]):
            if all(end <= a or first >= b for a, b in taken):
                taken.append((first, end))
                out.append((r, name, first, end, -share))
    return sorted(out, key=lambda m: (m[0], m[2], m[1]))


def license_spans(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id, licenses, spans`` of every document: distinct names, and words of each match."""
    bound_arrow_batches(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(build_licenses(templates))
    span = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("contained", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for r, name, first, end, share in scan(split_words(batch.column("text"), ALNUM), index.value):
                spans[r].append({"license": name, "start": first, "end": end, "contained": share})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<license:string,start:long,end:long,contained:double>>"
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
    names = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["license"])))
    return found.select("doc_id", names.alias("licenses"), "spans")
