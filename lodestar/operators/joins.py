"""Many-to-one joins, planned without running anything.

The right side holds at most one row per key. Left to itself Spark broadcasts the sides
whose file sizes fit ``spark.sql.autoBroadcastJoinThreshold``, measures the others at
their shuffles and splits skewed partitions. Where a side is known to be large and the
left side is written already, ``spread`` takes the hot keys of the left side apart before
the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOT_SHARE = 0.01


@dataclass(frozen=True)
class Side:
    """Right side of a many-to-one join.

    ``on`` maps a left column (or expression) to a right column; ``take`` maps an
    output name to a right column. Name the left expression by an alias.
    """

    frame: DataFrame
    on: Sequence[tuple[Column, str]]
    take: Mapping[str, str]

    def projected(self, tag: str) -> DataFrame:
        keys = [F.col(right).alias(f"{tag}k{i}") for i, (_, right) in enumerate(self.on)]
        return self.frame.select(*keys, *[F.col(c).alias(name) for name, c in self.take.items()])


def hot_hashes(df: DataFrame, keys: Sequence[Sequence[Column]], share: float = HOT_SHARE) -> list[list[int]]:
    """Per key, hashes of the values that may hold more than ``share`` of the rows.

    One frequent-items pass over the key columns serves all keys. It returns every
    such value and at most ``1 / share`` candidates per key, whatever the data size.
    """
    names = [f"h{i}" for i in range(len(keys))]
    hashed = df.select(*[F.xxhash64(*cols).alias(n) for n, cols in zip(names, keys)])
    found = hashed.stat.freqItems(names, share).first()
    return [[h for h in (found[f"{n}_freqItems"] or []) if h is not None] for n in names]


def _spread(
    left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], how: str, hot: list[int], salts: int,
    salt_by: list[str],
) -> DataFrame:
    """Shuffle join; rows of a hot key go to ``salts`` partitions by their content."""
    cond = [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys)]
    if not hot:
        return left.join(right, cond, how)
    zero = F.lit(0).cast("long")
    name = f"__salt_{left_keys[0]}"
    is_hot = F.xxhash64(*[F.col(k) for k in left_keys]).isin(hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.lit(salts))).otherwise(zero)
    copied = F.xxhash64(*[F.col(k) for k in right_keys]).isin(hot)
    copies = F.when(copied, F.sequence(zero, F.lit(salts - 1).cast("long"))).otherwise(F.array(zero))
    left = left.withColumn(name, salt)
    right = right.withColumn(f"{name}_copy", F.explode(copies))
    return left.join(right, [*cond, F.col(name) == F.col(f"{name}_copy")], how)


def join_sides(
    left: DataFrame,
    sides: Sequence[Side],
    how: str = "left",
    spread: bool = False,
    salts: int | None = None,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Join every side to ``left``, adding the ``take`` columns.

    Nothing runs before the action. With ``spread`` one pass over the keys of ``left``
    runs at once, and the rows of every key that may hold more than ``hot_share`` of them
    go to ``salts`` partitions, by default as many as a shuffle has.
    """
    prepared = [s.projected(f"__r{i}") for i, s in enumerate(sides)]

    def keys(i: int) -> list[Column]:
        types = [f.dataType for f in prepared[i].schema.fields]
        return [expr.cast(t) for (expr, _), t in zip(sides[i].on, types)]

    hot = hot_hashes(left, [keys(i) for i in range(len(sides))], hot_share) if spread else []
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt_by = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    left_keys = {i: [f"__l{i}k{j}" for j in range(len(side.on))] for i, side in enumerate(sides)}
    out = left.withColumns({name: expr for i in left_keys for name, expr in zip(left_keys[i], keys(i))})
    for i, side in enumerate(sides):
        right_keys = [f"__r{i}k{j}" for j in range(len(side.on))]
        out = _spread(out, prepared[i], left_keys[i], right_keys, how, hot[i] if spread else [], salts, salt_by)
    return out.select(*left.columns, *[name for s in sides for name in s.take])
