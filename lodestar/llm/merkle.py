"""Merkle manifest of a dataset: leaves, subtrees per group, a root, proofs and their check.

Rows of a group stand in a given order and are the leaves of the group's tree. While a
tree has several nodes, every ``arity`` consecutive ones become the digest of their
digests, as hex text; a last run may be shorter, even one node. The roots of the groups,
in the groups' order, are the leaves of one more tree.

A level is built by a self-join. A node knows the indices of its siblings: its own and
``index ^ 1`` in a binary tree, all slots of its run otherwise. Equijoined with the nodes
that have these indices it holds what stands left and right of it, which is its entry in
every proof that passes through it; the rows of slot zero also emit the parents. Levels
shrink by ``arity`` and are written one by one. Proofs are put together downwards: a node's proof is its
own entry and its parent's proof, so each shared part is stored once per level, and the
rows of the dataset meet only the proofs of their parents, last of all. Digests are stored and shuffled as 32
bytes; they are hashed as hex text.

Positions come from range partitions and their counts (:mod:`lodestar.operators.ordering`), so no
group is sorted in one task; a group that holds most rows has as many tasks as it has parts.

Defined cases: a null is ``-``, so it differs from an empty text, which is ``0:``; a null group is the first
one; rows of a group with equal or null order columns stand by their leaf, nulls first, and repeated rows are leaves of
their own. An empty table has no root. Columns that are not named are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.llm.common import cut_lineage
from lodestar.operators.ordering import part_offsets, place, sorted_parts

ARITY = 8


def row_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256 in hex of the values, each as ``-`` if null, else its bytes in UTF-8, ``:`` and the value."""
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def _hex(data: str | Column) -> Column:
    return F.lower(F.hex(data))


def _node(*digests: str | Column) -> Column:
    """The digest of digests as hex text."""
    return F.unhex(F.sha2(_hex(F.concat(*digests)), 256))


def _siblings(arity: int) -> Column:
    """Indices of the nodes in the run of a node, itself included."""
    i = F.col("idx")
    if arity == 2:
        last = F.col("size") - 1
        both = F.when(i.bitwiseXOR(F.lit(1)) <= last, F.array(i, i.bitwiseXOR(F.lit(1)))).otherwise(F.array(i))
        return both
    first = F.expr(f"idx div {arity}") * arity
    return F.sequence(first, F.least(first + (arity - 1), F.col("size") - 1))


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """``tree, idx, size, left, digest, right`` of the nodes of trees with several nodes."""
    asks = nodes.filter("size > 1").select("tree", "idx", "size", F.explode(_siblings(arity)).alias("sibling"))
    given = nodes.filter("size > 1").select("tree", F.col("idx").alias("sibling"), "digest")
    met = asks.join(given, ["tree", "sibling"]).groupBy("tree", "idx", "size")
    run = met.agg(F.array_sort(F.collect_list(F.struct("sibling", "digest"))).alias("run"))

    def side(test: str) -> Column:
        return F.expr(f"aggregate(filter(run, s -> s.sibling {test} idx), X'', (d, s) -> concat(d, s.digest))")

    return cut_lineage(run.select("tree", "idx", "size", side("<").alias("left"), side("=").alias("digest"), side(">").alias("right")))


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The rows of slot zero name their run."""
    return level.filter(f"idx % {arity} = 0").select(
        "tree",
        F.expr(f"idx div {arity}").alias("idx"),
        F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
        _node("digest", "right").alias("digest"),
    )


@dataclass
class _Forest:
    """Levels of many trees, the leaves' first, and ``tree, digest`` of all roots."""

    levels: list[DataFrame]
    roots: DataFrame
    arity: int

    def proofs(self, above: DataFrame) -> DataFrame:
        """``tree, idx, path`` and the other columns of ``above`` for the parents of the leaves, and for lone leaves.

        ``above`` has one row per tree with the ``path`` of its root.
        """
        found = None
        for level in reversed(self.levels[1:]):
            found = _entries(level, self._heads(found, above, level), self.arity)
        return self._heads(found, above, self.levels[0] if self.levels else None)

    def _heads(self, found: DataFrame | None, above: DataFrame, level: DataFrame | None) -> DataFrame:
        """Nodes above ``level``: those with a proof so far, and the roots of trees that end there."""
        end = above.withColumn("idx", F.lit(0).cast("long"))
        if level is None:
            return end
        ends = level.filter(f"idx = 0 and size <= {self.arity}").select("tree")
        roots = end.join(ends, "tree")
        return roots if found is None else found.unionByName(roots)


def _entries(level: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """``path``, and what else ``level`` and ``above`` carry, for every node of ``level``."""
    up = above.withColumnRenamed("idx", "up").withColumnRenamed("path", "rest")
    own = level.withColumns({"own": F.struct("left", "right"), "up": F.expr(f"idx div {arity}")})
    kept = [c for c in level.columns if c not in ("size", "left", "digest", "right")]
    more = [c for c in above.columns if c not in ("tree", "idx", "path")]
    return own.join(up, ["tree", "up"]).select(*kept, F.concat(F.array("own"), "rest").alias("path"), *more)


def _grow(leaves: DataFrame, arity: int) -> _Forest:
    """All levels over ``leaves`` (``tree, idx, size, digest``); a written table at each."""
    nodes, levels, roots = leaves, [], leaves.filter("size = 1").select("tree", "digest")
    while not nodes.filter("size > 1").isEmpty():
        level = _level(nodes, arity)
        levels.append(level)
        nodes = cut_lineage(_parents(level, arity))
        roots = roots.unionByName(nodes.filter("size = 1").select("tree", "digest"))
    return _Forest(levels, cut_lineage(roots), arity)


@dataclass
class Manifest:
    """A dataset's leaves with their places, its trees, and the root (None without rows)."""

    leaves: DataFrame
    groups: DataFrame
    forest: _Forest
    top: _Forest
    root: str | None

    def proved(self) -> DataFrame:
        """``kept``, ``leaf``, ``subroot`` and ``path``, the proof from the leaf to the root.

        An entry of a path has what stands ``left`` and ``right`` of the node in its run.
        """
        above = _tops(self.top, self.groups.select(F.col("tree").alias("idx")))
        above = cut_lineage(above.join(self.forest.roots.withColumnRenamed("digest", "subroot"), "tree"))
        names = ["kept", _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), "path"]
        lone = self.leaves.filter("size = 1").join(above, "tree").select(*names)
        if not self.forest.levels:
            return lone
        # the rows meet their own entries first, and the long paths once, in the last join
        own = self.leaves.select("tree", "idx", "kept", "leaf").join(self.forest.levels[0].drop("size", "digest"), ["tree", "idx"])
        return _entries(own, self.forest.proofs(above), self.forest.arity).select(*names).unionByName(lone)


def _tops(top: _Forest, groups: DataFrame) -> DataFrame:
    """``tree, path`` of the root of every group's tree."""
    empty = F.expr("cast(array() as array<struct<left:binary,right:binary>>)")
    if not top.levels:
        return groups.select(F.col("idx").alias("tree"), empty.alias("path"))
    above = top.roots.select("tree", empty.alias("path"))
    places = _entries(top.levels[0], top.proofs(above), top.arity)
    return places.select(F.col("idx").alias("tree"), "path")


def build_manifest(
    rows: DataFrame, columns: Sequence[str], group: str, order: Sequence[str], keep: Sequence[Column] = (), arity: int = ARITY
) -> Manifest:
    """Manifest of ``rows``: leaves over ``columns``, a tree for each value of ``group``, leaves by ``order``.

    ``keep`` are further columns that stay beside each leaf.
    """
    own = [F.col(c).alias(f"o{k}") for k, c in enumerate(order)]
    picked = rows.select(F.col(group).alias("grp"), *own, F.unhex(row_digest(columns)).alias("leaf"), F.struct(*order, *keep).alias("kept"))
    by = [F.asc_nulls_first("grp"), *(F.asc_nulls_first(f"o{k}") for k in range(len(own))), F.asc("leaf")]
    parts = sorted_parts(picked, by)
    offsets = part_offsets(parts, ["grp"])
    groups = sorted_parts(offsets.select("grp").distinct(), [F.asc_nulls_first("grp")])
    groups = place(groups, part_offsets(groups, []), [], "tree").withColumnRenamed("total", "trees")
    groups = cut_lineage(groups)
    numbered = offsets.alias("f").join(groups.alias("g"), F.col("f.grp").eqNullSafe(F.col("g.grp")))
    numbered = cut_lineage(numbered.select("f.*", "g.tree"))
    leaves = cut_lineage(place(parts, numbered, ["grp"], "idx").withColumnRenamed("total", "size").select("tree", "idx", "size", "leaf", "kept"))
    forest = _grow(leaves.select("tree", "idx", "size", F.col("leaf").alias("digest")), arity)
    tops = forest.roots.join(groups.select("tree", "trees"), "tree")
    tops = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("size"), "digest")
    top = _grow(cut_lineage(tops), arity)
    root = top.roots.first()
    return Manifest(leaves, groups, forest, top, bytes(root["digest"]).hex() if root else None)


def proof_digest(path: str = "path") -> Column:
    """SHA-256 of the siblings of a path, level by level, left to right."""
    siblings = F.aggregate(F.col(path), F.lit(b""), lambda d, s: F.concat(d, s["left"], s["right"]))
    return F.sha2(_hex(siblings), 256)


def fold(leaf: Column, path: str = "path") -> Column:
    """The root that ``leaf`` (hex) and the siblings of its path lead to."""
    return F.aggregate(F.col(path), leaf, lambda d, s: F.sha2(F.concat(_hex(s["left"]), d, _hex(s["right"])), 256))
