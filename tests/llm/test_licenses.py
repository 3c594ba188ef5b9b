"""License scans against brute force over all places."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm.licenses import CONTAINED, TEMPLATES, bands_needed, build_licenses, license_spans, scan
from lodestar.llm.words import ALNUM, split_words

SCHEMA = "doc_id long, text string, spans string, licenses int"


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    """Names of the templates that some stretch of twice their length contains, none hidden by an overlap with a better one."""
    ws, found = words(text), []
    for name, template in TEMPLATES.items():
        t = words(template)
        own = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
        for at in range(len(ws) - 4):
            if tuple(ws[at : at + 5]) in own:
                inside = {tuple(ws[k : k + 5]) for k in range(at, min(at + len(t) - 4, len(ws) - 4))} & own
                share = len(inside) / len(own)
                if share >= CONTAINED:
                    found.append((-share, -len(t), name, at, at + len(t)))
    names, taken = set(), []
    for share, _, name, a, b in sorted(found):
        if all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            names.add(name)
    return sorted(names)


def made():
    rng = np.random.default_rng(8)
    filler = [f"f{i}" for i in range(50)]
    rows = []
    for i in range(150):
        text = list(rng.choice(filler, rng.integers(0, 120)))
        for _ in range(rng.integers(0, 3)):
            notice = TEMPLATES[str(rng.choice(sorted(TEMPLATES)))].split()
            if len(notice) > 15 and rng.random() < 0.5:
                notice[0] = "Other"
            at = rng.integers(0, len(text) + 1)
            text[at:at] = ["."] + [w.upper() if rng.random() < 0.2 else w for w in notice] + ["|"]
        rows.append((i, " ".join(text)))
    return rows


def test_against_brute_force(spark):
    rows = made() + [(900, None), (901, ""), (902, "mit license"), (None, TEMPLATES["MIT/1"]), (903, "a b c d e f " * 20_000), (903, "x")]
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    got = sorted(((repr(r["doc_id"]), r["licenses"]) for r in license_spans(frame).collect()))
    assert got == sorted((repr(i), brute(t)) for i, t in rows)
    assert license_spans(frame.limit(0)).isEmpty()


def test_every_alignment_is_found():
    index = build_licenses()
    for name, template in TEMPLATES.items():
        for before in range(40):
            text = "w " * before + template + " end" * 50
            found = scan(split_words(pa.array([text]), ALNUM), index)
            assert found == [(0, name, before, before + len(words(template)), 1.0)]


def test_versions_are_told_apart():
    found = scan(split_words(pa.array([TEMPLATES["GPL-2.0/1"] + " x " + TEMPLATES["GPL-3.0/1"]]), ALNUM), build_licenses())
    assert [m[1] for m in found] == ["GPL-2.0/1", "GPL-3.0/1"]


def test_bands_and_templates():
    for s in (0.2, 0.25, 0.5):
        assert (1 - s) ** bands_needed(s) <= 1e-6 < (1 - s) ** (bands_needed(s) - 1)
    with pytest.raises(ValueError):
        build_licenses({"x": "too short"})
    assert scan(split_words(pa.array(["some words of a text here"]), ALNUM), build_licenses({})) == []
