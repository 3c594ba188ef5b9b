"""The manifest against a tree built row by row."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lodestar.llm.merkle import build_manifest, fold, proof_digest, row_digest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx string, tree long, leaf int, part string, at string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, arity):
    """The root of digests and, for each, the (left, right) of every level."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, k in enumerate(own):
            run = k // arity * arity
            paths[path].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + arity])))
        nodes = [digest("".join(nodes[k : k + arity])) for k in range(0, len(nodes), arity)]
        own = [k // arity for k in own]
    return nodes[0] if nodes else None, paths


def brute(rows, arity=8):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, *climb([leaf_of(r) for r in own], arity)))
    root, upper = climb([t[1] for t in trees], arity)
    out = []
    for (own, subroot, paths), above in zip(trees, upper):
        for r, path in zip(own, paths):
            whole = path + above
            out.append((r[0], leaf_of(r), subroot, root, digest("".join(a + b for a, b in whole))))
    return sorted(out, key=repr)


def rows_of(n):
    texts = ["", None, "Größe A\nb", "x" * 70_000, "tail "]
    langs = ["en", "en", "de", None, "", "é", "z"]
    rows = [(k * 7 % 1000, f"s{k % 4}" if k % 5 else None, langs[k % 7] if k > 20 else "en", None if k % 11 == 0 else k, texts[k % 5]) for k in range(n)]
    return rows + rows[:3] + [(None, None, None, None, None)] * 2


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", "z") for r in rows], SCHEMA)


@pytest.mark.parametrize(("n", "arity"), [(0, 8), (1, 8), (150, 8), (21, 2)])
def test_against_brute_force(spark, n, arity):
    rows = rows_of(n) if n > 1 else [(5, "s", "en", 3, "abc")][:n]
    manifest = build_manifest(frame(spark, rows), COLUMNS, "lang", ["doc_id"], arity=arity)
    found = manifest.proved().select(F.col("kept.doc_id"), "leaf", "subroot", F.lit(manifest.root).cast("string"), proof_digest(), fold(F.col("leaf")))
    got = found.collect()
    assert sorted((tuple(r[:5]) for r in got), key=repr) == brute(rows, arity)
    assert all(r[5] == manifest.root for r in got)


def test_a_changed_row_does_not_verify(spark):
    rows = rows_of(60)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = row_digest([*COLUMNS[:-1], lowered]).alias("tampered")
    manifest = build_manifest(frame(spark, rows), COLUMNS, "lang", ["doc_id"], [tampered, F.col("text").alias("was")])
    for r in manifest.proved().select("kept.was", fold(F.col("kept.tampered")).alias("folded")).collect():
        assert (r["folded"] == manifest.root) == (r["was"] is None or r["was"].lower() == r["was"] or "A" not in r["was"])


def test_query_names_the_tampered_rows(spark, tmp_path):
    from lodestar.llm.queries import op11_merkle_manifest

    rows = [(k, "s", "en" if k % 3 else "fr", 4, "Text" if k % 2 else "text") for k in range(40)]
    frame(spark, rows).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    for r in op11_merkle_manifest(spark, str(tmp_path)).collect():
        assert r["verified"] == (r["doc_id"] % 2 == 0 or zlib.crc32(str(r["doc_id"]).encode()) % 3 != 0)
