"""Maintenance of versioned dimensions.

A dimension row is a business key, attributes, a surrogate key, the interval
``date_active_from`` / ``date_active_to`` and ``dw_active`` ('A' or 'I').
``changes`` is always the output of ``image_diff`` between the new source image and
the last loaded one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodestar.functions.columns import fill_blank, fill_empty, fill_null, ts_lit
from lodestar.functions.reserved import ACTIVE, DIM_OPEN_END, ERROR_ID, ERROR_TEXT, INACTIVE, NA_ID, NA_TEXT, UNKNOWN_DATE
from lodestar.operators.diff import DELETE, INSERT, NOCHANGE, UPDATE
from lodestar.operators.extract import effective_now
from lodestar.operators.keys import KEY_BUCKETS, assign_surrogate_keys, continue_surrogate_keys, key_bucket

CONTROL = ("date_active_from", "date_active_to", "dw_active")


@dataclass(frozen=True)
class DimSpec:
    """How one dimension is loaded.

    ``scd1`` / ``scd2`` are the compared source columns. A missing attribute takes the
    'unknown' value of its type unless ``defaults`` gives another (None: leave it);
    ``blank`` says what counts as missing in text: ``both`` NULL and '', ``empty``
    only '', ``null`` only NULL. ``renames`` maps a
    source column to its dimension column. ``also_overwrite`` names columns that a
    type-1 change rewrites besides the type-1 ones. ``carried`` are loaded but not
    compared. With ``buckets`` (a divisor of 4096) the stage image and the dimension are
    kept in that many parts by key, and a load reads and rewrites only the parts of the
    dimension that hold moved keys.
    """

    name: str
    key: str
    scd1: tuple[str, ...]
    scd2: tuple[str, ...] = ()
    surrogate: str | None = None
    carried: tuple[str, ...] = ()
    defaults: Mapping[str, Any] = field(default_factory=dict)
    blank: str = "both"
    renames: Mapping[str, str] = field(default_factory=dict)
    also_overwrite: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self) -> None:
        if self.buckets and KEY_BUCKETS % self.buckets:
            raise ValueError(f"{self.name}: {self.buckets} does not divide {KEY_BUCKETS}")

    def part(self) -> Column:
        """Name of the part a row is kept in; keys that share a part share the buckets of their surrogate keys."""
        return F.format_string(f"b%dof{self.buckets}", F.pmod(key_bucket([self.key]), F.lit(self.buckets)))

    @property
    def attributes(self) -> list[str]:
        """Loaded source columns besides the key, each once."""
        return list(dict.fromkeys([*self.carried, *self.scd2, *self.scd1]))

    @property
    def overwritten(self) -> list[str]:
        return list(dict.fromkeys([*self.scd1, *self.also_overwrite]))

    def target(self, column: str) -> str:
        return self.renames.get(column, column)

    def filled(self, column: str, value: Column, dtype: T.DataType) -> Column:
        default = self.defaults[column] if column in self.defaults else unknown_value(dtype)
        if default is None:
            return value
        if isinstance(dtype, T.StringType):
            fill = {"both": fill_blank, "empty": fill_empty, "null": fill_null}[self.blank]
            return fill(value, default)
        return fill_null(value, F.lit(default).cast(dtype))


def unknown_value(dtype: T.DataType) -> Any:
    """The reserved 'unknown' value of a type; None for types that have none."""
    if isinstance(dtype, T.StringType):
        return NA_TEXT
    if isinstance(dtype, T.NumericType):
        return NA_ID
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return UNKNOWN_DATE
    return None


def _new_type(changes: DataFrame, column: str) -> T.DataType:
    return changes.schema["new"].dataType[column].dataType


def _attribute(changes: DataFrame, spec: DimSpec, column: str) -> Column:
    return spec.filled(column, F.col("new")[column], _new_type(changes, column))


def _expired_at(run_ts: str | dt.datetime, expire_offset: str) -> Column:
    return ts_lit(run_ts) - F.expr(f"INTERVAL {expire_offset}")


def _versions(changes: DataFrame, spec: DimSpec, run_ts: str | dt.datetime) -> DataFrame:
    return changes.select(
        F.col(spec.key),
        *[_attribute(changes, spec, c).alias(spec.target(c)) for c in spec.attributes],
        ts_lit(run_ts).alias("date_active_from"),
        ts_lit(DIM_OPEN_END).alias("date_active_to"),
        F.lit(ACTIVE).alias("dw_active"),
    )


def scd_insert(
    changes: DataFrame,
    spec: DimSpec,
    run_ts: str | dt.datetime,
    dim: DataFrame | None = None,
    op: str | None = INSERT,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """New versions: of new keys, of type-2 changed keys, or of both (``op=None``)."""
    new = F.col("op") == INSERT
    changed = (F.col("op") == UPDATE) & (F.col("ch_type") == 2)
    wanted = {INSERT: new, UPDATE: changed, None: new | changed}[op]
    versions = _versions(changes.filter(wanted), spec, run_ts)
    if spec.surrogate is None:
        return versions
    give = continue_surrogate_keys if spec.buckets else assign_surrogate_keys
    return give(versions, spec.key, spec.surrogate, dim, buckets)


def _touch(
    dim: DataFrame,
    changes: DataFrame,
    spec: DimSpec,
    run_ts: str | dt.datetime,
    expire_offset: str,
    delete_scope: str,
    expire: bool,
    overwrite: bool,
    delete: bool,
) -> DataFrame:
    """Existing versions after the wanted changes; one join, whatever is asked."""
    relevant = changes.filter(F.col("op").isin(UPDATE, DELETE)).select(
        F.col(spec.key).alias("__key"),
        F.col("op").alias("__op"),
        F.col("ch_type").alias("__ch"),
        *([_attribute(changes, spec, c).alias(f"__new_{c}") for c in spec.overwritten] if overwrite else []),
    )
    now = effective_now(run_ts)
    closes = F.lit(False)
    if expire:
        closes = closes | ((F.col("__op") == UPDATE) & (F.col("__ch") == 2) & now)
    if delete:
        scope = F.lit(True) if delete_scope == "all" else F.col("dw_active") == ACTIVE
        closes = closes | ((F.col("__op") == DELETE) & scope)
    out: dict[str, Column] = {
        "date_active_to": F.when(closes, _expired_at(run_ts, expire_offset)).otherwise(F.col("date_active_to")),
        "dw_active": F.when(closes, F.lit(INACTIVE)).otherwise(F.col("dw_active")),
    }
    if overwrite:
        rewritten = (F.col("__op") == UPDATE) & (F.col("__ch") == 1)
        for c in spec.overwritten:
            name = spec.target(c)
            out[name] = F.when(rewritten, F.col(f"__new_{c}")).otherwise(F.col(name))
    joined = dim.join(relevant, F.col(spec.key) == F.col("__key"), "left")
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in dim.columns])


def scd2_expire(
    dim: DataFrame, changes: DataFrame, spec: DimSpec, run_ts: str | dt.datetime, expire_offset: str = "1 DAY"
) -> DataFrame:
    """Close the effective version of every key with a type-2 change."""
    return _touch(dim, changes, spec, run_ts, expire_offset, "active", True, False, False)


def scd1_update(dim: DataFrame, changes: DataFrame, spec: DimSpec, run_ts: str | dt.datetime) -> DataFrame:
    """Overwrite type-1 attributes in every version of a key with a type-1 change."""
    return _touch(dim, changes, spec, run_ts, "0 DAY", "active", False, True, False)


def soft_delete(
    dim: DataFrame,
    changes: DataFrame,
    spec: DimSpec,
    run_ts: str | dt.datetime,
    expire_offset: str = "1 DAY",
    delete_scope: str = "active",
) -> DataFrame:
    """Close the versions of keys that left the source; the rows stay.

    ``delete_scope='all'`` also moves the end of versions that were closed before.
    """
    return _touch(dim, changes, spec, run_ts, expire_offset, delete_scope, False, False, True)


def scd_merge(
    dim: DataFrame,
    changes: DataFrame,
    spec: DimSpec,
    run_ts: str | dt.datetime,
    expire_offset: str = "1 DAY",
    delete_scope: str = "active",
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """The dimension after one load.

    Existing versions are joined once with the changed keys and closed or rewritten
    in that pass; new keys and type-2 changes come straight from the changes. A
    key has one kind of change, so this equals the step-by-step order. A key that
    returns after a delete is an insert and starts a new version.
    """
    moved = changes.filter(F.col("op") != NOCHANGE)
    kept = _touch(dim, moved, spec, run_ts, expire_offset, delete_scope, True, True, True)
    added = scd_insert(moved, spec, run_ts, dim, None, buckets)
    return kept.unionByName(added.select(*dim.columns))


def default_members(spec: DimSpec, dim: DataFrame) -> list[dict[str, Any]]:
    """The 'not available' and 'in error' members of a dimension.

    Business and surrogate key are the reserved id, texts the reserved text, other
    attributes NULL; they are active throughout.
    """
    always = {"date_active_from": dt.datetime(1900, 1, 1), "date_active_to": dt.datetime.fromisoformat(DIM_OPEN_END), "dw_active": ACTIVE}
    ids = [c for c in (spec.target(spec.key), spec.surrogate) if c is not None]
    texts = [f.name for f in dim.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (*ids, *CONTROL)]
    return [
        {**{c: text for c in texts}, **{c: id for c in ids}, **always} for id, text in ((NA_ID, NA_TEXT), (ERROR_ID, ERROR_TEXT))
    ]


def seed_default_members(dim: DataFrame, members: Sequence[Mapping[str, Any]], key: str | Sequence[str]) -> DataFrame:
    """Add constant members (such as 'not available' and 'in error') that are missing.

    A member whose key is present already is not added again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = [tuple(m.get(c) for c in dim.columns) for m in members]
    seed = dim.sparkSession.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType, True) for f in dim.schema.fields]))
    wanted = F.struct(*[F.col(k) for k in keys]).isin(*[F.struct(*[F.lit(m[k]).cast(dim.schema[k].dataType) for k in keys]) for m in members])
    present = dim.filter(wanted).select(*keys).distinct()
    return dim.unionByName(seed.join(F.broadcast(present), keys, "left_anti").select(*dim.columns))
