"""Parent-child hierarchies: parent attributes, depths and ancestor closures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lodestar.operators.joins import Side, join_sides
from lodestar.session import cut_lineage


def parent_lookup(
    df: DataFrame,
    key: str,
    parent: str,
    attrs: Mapping[str, str],
    source: DataFrame | None = None,
) -> DataFrame:
    """Add attributes of the parent row; NULL where there is none.

    ``attrs`` maps an output column to a column of the parent. Parents are looked
    up in ``source``, or in ``df`` itself.
    """
    side = Side(df if source is None else source, [(F.col(parent), key)], attrs)
    return join_sides(df, [side])


def _climb(
    edges: DataFrame, key: str, parent: str, attrs: Mapping[str, str], paths: bool, known: DataFrame | None = None
) -> DataFrame:
    """Rows of ``edges`` that reach a root, with ``__depth`` and maybe ``__path``.

    ``known`` are further rows whose depths and paths are there already; they are handed back too.

    Every open row knows an ancestor and the distance to it. One round joins it
    with that ancestor's row and doubles the distance, so a hierarchy of depth d
    takes about log2(d) joins. Rows whose chain ends at an unknown id find no
    partner and leave. As long as rows reach a root in a round there may be more to
    come; once none does, what is left runs in circles and leaves too.
    """
    step = F.array(F.struct(F.col(parent).alias("id"), *[F.col(c).alias(c) for c in attrs]))
    rooted = F.col(parent).isNull()
    state = edges.withColumns(
        {
            "__next": F.col(parent),
            "__depth": F.when(rooted, 0).otherwise(1),
            **({"__path": F.when(rooted, F.slice(step, 1, 0)).otherwise(step)} if paths else {}),
        }
    )
    state = cut_lineage(state)
    is_done = F.col("__next").isNull()
    done = state.filter(is_done)
    if known is not None:
        done = done.unionByName(known.withColumn("__next", F.lit(None).cast(edges.schema[parent].dataType)))
    open_rows = state.filter(~is_done)
    while not open_rows.isEmpty():
        take = {"__n": "__next", "__d": "__depth", **({"__p": "__path"} if paths else {})}
        partners = done.unionByName(open_rows)
        stepped = join_sides(open_rows, [Side(partners, [(F.col("__next"), key)], take)], "inner")
        moved = {"__next": F.col("__n"), "__depth": F.col("__depth") + F.col("__d")}
        if paths:
            moved["__path"] = F.concat("__path", "__p")
        stepped = cut_lineage(stepped.withColumns(moved).select(*state.columns))
        arrived = stepped.filter(is_done)
        if arrived.isEmpty():
            break
        done = done.unionByName(arrived)
        open_rows = stepped.filter(~is_done)
    return done.drop("__next")


def hierarchy_depth(
    edges: DataFrame,
    key: str,
    parent: str,
    root_level: int | None = None,
) -> DataFrame:
    """Rows reachable from a root with their ``level``; roots take ``root_level``.

    Orphans and members of cycles are never reached and drop out.
    """
    return _depths(_climb(edges, key, parent, {}, False), edges, root_level)


def _depths(found: DataFrame, edges: DataFrame, root_level: int | None) -> DataFrame:
    level = F.when(F.col("__depth") == 0, F.lit(root_level).cast("int")).otherwise(F.col("__depth"))
    return found.select(*edges.columns, level.cast("int").alias("level"))


def hierarchy_closure(
    edges: DataFrame,
    key: str,
    parent: str,
    attrs: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per node and ancestor, and one per node with itself.

    ``attrs`` maps a parent column of ``edges`` to the node's own column; in the
    result it describes the ancestor. ``level`` is the distance. ``q_level`` is the
    depth of the node, except 0 at depth 1, and NULL on the node's own row. Paths
    come with the rows, so the closure itself needs no further join.
    """
    attrs = dict(attrs or {})
    return _closure(_climb(edges, key, parent, attrs, True), edges, key, parent, attrs)


def hierarchy_tables(
    edges: DataFrame, key: str, parent: str, attrs: Mapping[str, str] | None = None, root_level: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``hierarchy_depth`` and ``hierarchy_closure`` of the same edges, climbed once."""
    attrs = dict(attrs or {})
    found = cut_lineage(_climb(edges, key, parent, attrs, True))
    return _depths(found, edges, root_level), _closure(found, edges, key, parent, attrs)


def changed_nodes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of the edges that were added, removed or altered in any column between two states."""
    columns = [c for c in new.columns if c != key]
    before, after = (df.select(key, F.struct(*columns).alias(name)) for df, name in ((old, "__old"), (new, "__new")))
    return before.join(after, key, "full_outer").filter(~F.col("__old").eqNullSafe(F.col("__new"))).select(key)


def hierarchy_closure_update(
    closure: DataFrame,
    edges: DataFrame,
    changed: DataFrame,
    key: str,
    parent: str,
    attrs: Mapping[str, str] | None = None,
) -> DataFrame:
    """``hierarchy_closure`` of ``edges``, from the closure of an earlier state.

    ``changed`` holds the keys of all edges that differ (see :func:`changed_nodes`). They, the
    nodes that stood below them and the nodes without a place in ``closure`` are climbed
    anew, and only up to the first ancestor that keeps its place, whose path is taken from
    ``closure``. All other rows of ``closure`` stay. Nodes that no longer reach a root go,
    orphans that found a parent come in.
    """
    attrs = dict(attrs or {})
    ids = changed.select(F.col(key).alias("__changed")).distinct()
    below = closure.join(ids, F.col(parent) == F.col("__changed"), "left_semi").select(key)
    unplaced = edges.select(key).join(closure.filter("level = 0").select(key), key, "left_anti")
    affected = cut_lineage(below.unionByName(unplaced).distinct())
    kept = closure.join(affected, key, "left_anti")
    todo = cut_lineage(edges.join(affected, key, "left_semi"))

    lenders = todo.select(F.col(parent).alias(key)).filter(F.col(key).isNotNull()).distinct()
    step = F.struct(F.col(parent).alias("id"), *[F.col(c).alias(c) for c in attrs])
    steps = F.array_sort(F.collect_list(F.when(F.col("level") > 0, F.struct(F.col("level").alias("at"), step.alias("step")))))
    paths = kept.join(lenders, key, "left_semi").groupBy(key).agg(F.transform(steps, lambda s: s["step"]).alias("__path"))
    known = cut_lineage(edges.join(paths, key).select(*edges.columns, F.size("__path").alias("__depth"), "__path"))
    found = cut_lineage(_climb(todo, key, parent, attrs, True, known).join(affected, key, "left_semi"))
    return kept.unionByName(_closure(found, edges, key, parent, attrs))


def _closure(found: DataFrame, edges: DataFrame, key: str, parent: str, attrs: Mapping[str, str]) -> DataFrame:
    self_step = F.struct(F.col(key).alias("id"), *[F.col(own).alias(c) for c, own in attrs.items()])
    rows = found.select(
        *[c for c in edges.columns if c != parent and c not in attrs],
        "__depth",
        F.posexplode(F.concat(F.array(self_step), F.col("__path"))).alias("level", "__step"),
    )
    q_level = F.when(F.col("level") == 0, None).when(F.col("__depth") == 1, 0).otherwise(F.col("__depth"))
    picked = {parent: F.col("__step.id"), **{c: F.col("__step")[c] for c in attrs}}
    return rows.select(
        *[picked.get(c, F.col(c)).alias(c) for c in edges.columns], "level", q_level.cast("int").alias("q_level")
    )
