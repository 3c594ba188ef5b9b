"""Comparison of a new source image with the last loaded one."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, DELETE, NOCHANGE = "insert", "update", "delete", "nochange"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _differs(cols: Iterable[str]) -> Column:
    tests = [~F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in cols]
    return reduce(or_, tests, F.lit(False))


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    # A NULL key never matches in the reload statements either.
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def image_diff(
    prestage: DataFrame,
    stage: DataFrame,
    key: str | Sequence[str],
    scd1: Sequence[str],
    scd2: Sequence[str] = (),
    partial: bool = False,
) -> DataFrame:
    """Both images of every key side by side, with ``op`` and ``ch_type``.

    Keys are unique on both sides (see ``latest_per_key``), so one shuffle by key
    compares everything. ``new`` and ``old`` hold the two rows. ``ch_type`` is 2
    if a type-2 column differs, else 1 if a type-1 column does; it is NULL unless
    ``op`` is ``update``. With ``partial`` the new image is an increment, and keys
    missing from it are unchanged instead of deleted.
    """
    keys = _keys(key)
    p = _keyed(prestage, keys).withColumn("__p", F.lit(True)).alias("p")
    s = _keyed(stage, keys).withColumn("__s", F.lit(True)).alias("s")
    joined = p.join(s, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys], "full")
    in_p, in_s = F.col("__p").isNotNull(), F.col("__s").isNotNull()
    change = F.when(_differs(scd2), 2).when(_differs(scd1), 1)
    op = (
        F.when(~in_s, INSERT)
        .when(~in_p, NOCHANGE if partial else DELETE)
        .when(change.isNotNull(), UPDATE)
        .otherwise(NOCHANGE)
    )
    return joined.select(
        *[F.coalesce(F.col(f"p.{k}"), F.col(f"s.{k}")).alias(k) for k in keys],
        op.alias("op"),
        F.when(in_p & in_s, change).cast("int").alias("ch_type"),
        in_p.alias("in_prestage"),
        F.struct(*[F.col(f"p.{c}").alias(c) for c in prestage.columns]).alias("new"),
        F.struct(*[F.col(f"s.{c}").alias(c) for c in stage.columns]).alias("old"),
    )


def increment_images(
    prestage: DataFrame,
    stage: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    compare: Sequence[str],
    deal: Sequence[str] = (),
) -> DataFrame:
    """``image_diff`` of an increment's ``latest_per_key`` with the stage, keys outside the increment being unchanged.

    Both are stacked and meet in one aggregate, hence in one shuffle. ``deal`` names columns of the key to
    shuffle by, the whole key by default; the rows stay where these columns have sent them.
    """
    keys = _keys(key)
    first = [order] if isinstance(order, str) else list(order)
    rest = [c for c in prestage.columns if c not in keys and c not in first]
    p = _keyed(prestage, keys).withColumn("__new", F.lit(True))
    stacked = p.unionByName(_keyed(stage, keys).withColumn("__new", F.lit(False))).repartition(*(deal or keys))
    row = F.struct(*[F.col(c) for c in first + rest])
    met = stacked.groupBy(*keys).agg(
        F.max(F.when(F.col("__new"), row)).alias("__p"), F.first(F.when(~F.col("__new"), row), ignorenulls=True).alias("__s")
    )
    in_p, in_s = F.col("__p").isNotNull(), F.col("__s").isNotNull()
    tests = [~F.col("__p")[c].eqNullSafe(F.col("__s")[c]) for c in compare]
    op = F.when(~in_s, INSERT).when(in_p & reduce(or_, tests, F.lit(False)), UPDATE).otherwise(NOCHANGE)
    sides = {
        name: F.struct(*[F.col(c) if c in keys else F.col(side)[c].alias(c) for c in prestage.columns]).alias(name)
        for name, side in (("new", "__p"), ("old", "__s"))
    }
    return met.select(*keys, op.alias("op"), in_p.alias("in_prestage"), *sides.values())


def snapshot_diff(
    prestage: DataFrame,
    stage: DataFrame,
    key: str | Sequence[str],
    scd1: Sequence[str],
    scd2: Sequence[str] = (),
) -> DataFrame:
    """One row per key: ``insert``, ``update`` (with ``ch_type``), ``delete`` or ``nochange``."""
    return image_diff(prestage, stage, key, scd1, scd2).select(*_keys(key), "op", "ch_type")


def classify_changes(
    prestage: DataFrame, stage: DataFrame, key: str | Sequence[str], scd1: Sequence[str], scd2: Sequence[str] = ()
) -> DataFrame:
    """Changed keys with their change type."""
    return snapshot_diff(prestage, stage, key, scd1, scd2).filter(F.col("op") == UPDATE).select(*_keys(key), "ch_type")


def fact_changes(
    prestage: DataFrame, stage: DataFrame, key: str | Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """Rows of an increment with their ``op``: ``insert``, ``update`` or ``nochange``.

    The increment drives a left join, so stage keys outside it cost a scan of the
    compared columns and nothing more. All columns but the key are compared unless
    ``cols`` names some.
    """
    keys = _keys(key)
    cols = [c for c in prestage.columns if c not in keys] if cols is None else list(cols)
    p = _keyed(prestage, keys).alias("p")
    s = stage.select(*keys, *cols).withColumn("__s", F.lit(True)).alias("s")
    joined = p.join(s, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys], "left")
    op = F.when(F.col("__s").isNull(), INSERT).when(_differs(cols), UPDATE).otherwise(NOCHANGE)
    return joined.select("p.*", op.alias("op"))


def fact_diff(
    prestage: DataFrame, stage: DataFrame, key: str | Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """``op`` of every key of an increment."""
    return fact_changes(prestage, stage, key, cols).select(*_keys(key), "op")


def delta_counts(diff: DataFrame) -> DataFrame:
    """One row with the number of keys per kind of change."""

    return diff.agg(*count_columns())


def count_columns(op: str = "op") -> list[Column]:
    """The aggregates of ``delta_counts``, also for use with ``observe``; rows without an ``op`` are not counted."""

    def n(hit: Column, name: str) -> Column:
        return F.count(F.when(hit, True)).alias(name)

    kind = F.col(op)
    return [
        n(kind != DELETE, "ingested"),
        n(kind == INSERT, "inserted"),
        n(kind == UPDATE, "updated"),
        n(kind == DELETE, "deleted"),
        n(kind == NOCHANGE, "unchanged"),
    ]


def diff_balance(diff: DataFrame, ingested: DataFrame) -> DataFrame:
    """Counts next to the rows actually ingested; ``balanced`` if nothing got lost.

    ``ingested`` is the image the diff was made from. Inserted, updated and
    unchanged keys must add up to its rows.
    """
    found = diff.filter(F.col("op") != DELETE).groupBy("op").agg(F.count(F.lit(1)).alias("n"))
    rows = ingested.agg(F.count(F.lit(1)).alias("n")).select(F.lit("ingested").alias("op"), "n")
    n = lambda name: F.coalesce(F.sum(F.when(F.col("op") == name, F.col("n"))), F.lit(0))
    total = n(INSERT) + n(UPDATE) + n(NOCHANGE)
    return rows.unionByName(found).agg(
        n("ingested").alias("ingested"),
        n(INSERT).alias("inserted"),
        n(UPDATE).alias("updated"),
        n(NOCHANGE).alias("unchanged"),
        (n("ingested") == total).alias("balanced"),
    )


def refreshed_stage(images: DataFrame, columns: Sequence[str], *also: Column) -> DataFrame:
    """The next stage image, read off an ``image_diff``, with ``also`` as further columns.

    New and changed keys take the new row; unchanged keys keep the old one, also
    in columns that are not compared; deleted keys are gone.
    """
    take_new = F.col("op").isin(INSERT, UPDATE)
    return images.filter(F.col("op") != DELETE).select(
        *[F.when(take_new, F.col("new")[c]).otherwise(F.col("old")[c]).alias(c) for c in columns], *also
    )


def dim_stage_refresh(stage: DataFrame, moved: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The next stage image of a dimension out of the moved keys of an ``image_diff``.

    Changed and deleted keys leave, new and changed rows come in; whatever did not
    change is only passed through.
    """
    leaving = moved.filter(F.col("op").isin(UPDATE, DELETE)).select(*_keys(key))
    coming = moved.filter(F.col("op").isin(INSERT, UPDATE))
    return stage.join(leaving, _keys(key), "left_anti").select(*stage.columns).unionByName(
        coming.select(*[F.col("new")[c].alias(c) for c in stage.columns])
    )


def fact_stage_refresh(stage: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The next stage image of a fact: changed keys replaced, new keys added.

    Only the changed keys take part in the join; unchanged rows of the increment
    stay as they are.
    """
    moved = changes.filter(F.col("op").isin(INSERT, UPDATE))
    replaced = changes.filter(F.col("op") == UPDATE).select(*_keys(key))
    return stage.join(replaced, _keys(key), "left_anti").select(*stage.columns).unionByName(moved.drop("op"))


def stage_refresh(
    prestage: DataFrame,
    stage: DataFrame,
    key: str | Sequence[str],
    compare: Sequence[str],
    partial: bool = False,
) -> DataFrame:
    """The next stage image in one pass over both."""
    return refreshed_stage(image_diff(prestage, stage, key, compare, partial=partial), stage.columns)
