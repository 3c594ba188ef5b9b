"""Consecutive positions of rows in a global order, without a sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestar.session import cut_lineage

#: The low bits of ``monotonically_increasing_id`` count rows inside a partition.
_ROW_BITS = (1 << 33) - 1


def sorted_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in range partitions by ``order``, each sorted, with its ``part`` and the row's place ``at`` in it.

    Rows that are equal in ``order`` may fall into several partitions, so one hot value
    never fills a task. The result is a written table: its parts no longer move when a
    task is repeated.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())
    tied = df.withColumn("at", spread)
    dealt = tied.repartitionByRange(*order, F.col("at")).sortWithinPartitions(*order, "at")
    return cut_lineage(
        dealt.withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))).withColumn(
            "part", F.spark_partition_id()
        )
    )


def part_offsets(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """For each group and part: ``first_at``, the rows of the group ``before`` the part, and its ``total``.

    A window holds one row per part of a group, never the rows themselves.
    """
    counted = parts.groupBy(*groups, "part").agg(F.min("at").alias("first_at"), F.count("*").alias("n"))
    own = Window.partitionBy(*groups)
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(
        counted.select(
            *groups, "part", "first_at",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(own).alias("total"),
        )
    )


def place(parts: DataFrame, offsets: DataFrame, groups: Sequence[str], name: str = "position") -> DataFrame:
    """``parts`` with each row's place in its group, from 0, and the other columns of ``offsets``."""
    same = F.col("p.part") == F.col("o.part")
    for g in groups:
        same = same & F.col(f"p.{g}").eqNullSafe(F.col(f"o.{g}"))
    joined = parts.alias("p").join(offsets.alias("o"), same)
    kept = [F.col(f"p.{c}") for c in parts.columns if c not in ("part", "at")]
    more = [F.col(f"o.{c}") for c in offsets.columns if c not in (*groups, "part", "first_at", "before")]
    return joined.select(*kept, (F.col("at") - F.col("first_at") + F.col("before")).alias(name), *more)
