"""Shaping of source rows before they are compared or loaded."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from lodestar.functions.columns import ts_lit


def stamp_run_id(df: DataFrame, run_id: int) -> DataFrame:
    """Put the run id in front of every row."""
    return df.select(F.lit(run_id).alias("runid"), *df.columns)


def incremental_extract(
    df: DataFrame,
    ts_cols: str | Sequence[str],
    watermark: str | dt.datetime,
    filters: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Rows modified at or after the watermark in any of ``ts_cols``.

    ``filters`` holds equality filters such as the subsidiary. Comparisons with
    literals only, so the scan gets them as pushed filters.
    """
    cols = [ts_cols] if isinstance(ts_cols, str) else list(ts_cols)
    changed = reduce(or_, [F.col(c) >= ts_lit(watermark) for c in cols])
    equal = [F.col(c) == F.lit(v) for c, v in (filters or {}).items()]
    return df.filter(reduce(and_, equal, changed))


def active_only(df: DataFrame, flag: str, active: Any = "No") -> DataFrame:
    """Rows whose inactive flag holds the value for 'still active'."""
    return df.filter(F.col(flag) == F.lit(active))


def effective_now(
    run_ts: str | dt.datetime,
    start: str = "date_active_from",
    end: str = "date_active_to",
    flag: str = "dw_active",
    active: Any = "A",
) -> Column:
    """Version is the active one and its interval covers ``run_ts``."""
    now = ts_lit(run_ts)
    return (F.col(flag) == F.lit(active)) & (F.col(start) <= now) & (now < F.col(end))


def current_versions(dim: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """The versions a load looks surrogate keys up in."""
    return dim.filter(effective_now(run_ts))


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` values.

    Remaining columns break ties from left to right, so the result does not depend
    on row order; NULL is the smallest value. A grouped maximum of the row is used
    rather than a window: each task keeps one candidate per key before the
    shuffle, so many copies of one key do not meet in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in first]
    row = F.struct(*[F.col(c) for c in first + rest])
    return (
        df.groupBy(*keys)
        .agg(F.max(row).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    )


def document_union(parts: Iterable[DataFrame]) -> DataFrame:
    """Stack extracts of different document types, matching columns by name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def minus_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; NULL equals NULL."""
    return left.subtract(right.select(*left.columns))
