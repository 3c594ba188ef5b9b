"""Key resolution, versions and quarantine of fact rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lodestar.functions.columns import date_id, fill_null, ts_lit
from lodestar.functions.reserved import FACT_OPEN_END, NA_ID, RECORD_ERROR, RECORD_RESOLVED, RECORD_SUPERSEDED
from lodestar.operators.diff import INSERT, UPDATE
from lodestar.operators.joins import Side, join_sides


@dataclass(frozen=True)
class Lookup:
    """One surrogate-key lookup of a fact.

    ``fk`` are the business id columns of the fact, ``id`` the matching columns of
    ``dim``, ``key`` its surrogate key and ``name`` the fact's key column. A NULL id
    looks up ``default``. A ``date`` lookup matches the day of a timestamp. ``dim``
    holds one row per id (see ``current_versions``).
    """

    name: str
    dim: DataFrame
    fk: str | tuple[str, ...]
    id: str | tuple[str, ...]
    key: str
    default: Any = NA_ID
    date: bool = False

    def side(self) -> Side:
        fks = [self.fk] if isinstance(self.fk, str) else list(self.fk)
        ids = [self.id] if isinstance(self.id, str) else list(self.id)
        exprs = [date_id(c) if self.date else fill_null(c, self.default) for c in fks]
        return Side(self.dim, list(zip(exprs, ids)), {self.name: self.key})


def unresolved(lookups: Sequence[Lookup]) -> Column:
    """True if any key column is missing."""
    return reduce(or_, [F.col(x.name).isNull() for x in lookups])


def resolve_all(df: DataFrame, lookups: Sequence[Lookup], spread: bool = False) -> DataFrame:
    """Every row with all keys found so far; a key that was not found is NULL.

    Ids are defaulted before the join, which keeps each lookup an equi-join. See
    ``join_sides`` for ``spread``.
    """
    return join_sides(df, [x.side() for x in lookups], "left", spread)


def resolve_stacked(df: DataFrame, lookups: Sequence[Lookup], salts: int | None = None) -> DataFrame:
    """:func:`resolve_all` in one shuffle of the fact rows and two of their ids, however many lookups there are.

    The ids of a row become one row per lookup, which meet a single table of all
    dimensions' ids; the keys found come back together by row. Only there a row's own columns
    join them. A dimension that several lookups use stands in the table once. Ids
    that are absent look up the default member, which is copied ``salts`` times and shared out by row. Rows are
    told apart by their place in the scan, which is read for the ids and for the other columns, so ``df`` has to be
    read from a table. Meant for dimensions too large to broadcast; small ones are cheaper by :func:`resolve_all`.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [x.side() for x in lookups]
    tables: dict[tuple, tuple[int, DataFrame]] = {}
    asks, kinds = [], []
    # one id needs no array around it, and keys that are numbers no text
    pack = F.array if any(len(side.on) > 1 for side in sides) else lambda c: c
    number = all(isinstance(side.frame.schema[c].dataType, T.IntegralType) for side in sides for c in side.take.values())
    for lookup, side in zip(lookups, sides):
        ids, (key,) = [right for _, right in side.on], side.take.values()
        schema = side.frame.schema
        member = pack(*[F.lit("0" if lookup.date else str(lookup.default)) for _ in ids])
        tag, _ = tables.setdefault((id(side.frame), *ids, key), (len(tables), side.frame))
        asked = pack(*[expr.cast(schema[i].dataType).cast("string") for (expr, _), i in zip(side.on, ids)])
        slot = F.when(asked == member, F.pmod(F.xxhash64("__row"), F.lit(salts))).otherwise(F.lit(0).cast("long"))
        asks.append(F.struct(F.lit(tag).alias("tag"), asked.alias("ids"), slot.alias("slot")))
        kinds.append(schema[key].dataType)
    defaults: dict[int, set[str]] = {}
    for lookup, side in zip(lookups, sides):
        tag, _ = tables[(id(side.frame), *[right for _, right in side.on], *side.take.values())]
        defaults.setdefault(tag, set()).add("0" if lookup.date else str(lookup.default))

    def stacked(tag: int, frame: DataFrame, ids: Sequence[str], key: str) -> DataFrame:
        known = pack(*[F.col(i).cast("string") for i in ids])
        zero = F.lit(0).cast("long")
        is_default = reduce(or_, [known == pack(*[F.lit(d) for _ in ids]) for d in sorted(defaults[tag])])
        copies = F.when(is_default, F.sequence(zero, F.lit(salts - 1).cast("long"))).otherwise(F.array(zero))
        return frame.select(F.lit(tag).alias("tag"), known.alias("ids"), F.explode(copies).alias("slot"), F.col(key).cast("bigint" if number else "string").alias("key"))

    lookup_rows = reduce(DataFrame.unionByName, [stacked(tag, frame, name[1:-1], name[-1]) for name, (tag, frame) in tables.items()])
    # rows are numbered before they are exploded, so the ids of one row share its number
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    asking = numbered.select(F.col("__row").alias("row"), F.array(*asks).alias("asks"))
    role_rows = asking.select("row", F.posexplode("asks").alias("role", "ask")).select("row", "role", "ask.tag", "ask.ids", "ask.slot")
    met = role_rows.join(lookup_rows, ["tag", "ids", "slot"]).select("row", "role", "key")
    lines = numbered.select(F.col("__row").alias("row"), F.struct(*df.columns).alias("line"))
    keys = [F.max(F.when(F.col("role") == i, F.col("key"))).alias(f"k{i}") for i in range(len(lookups))]
    both = lines.unionByName(met, allowMissingColumns=True)
    back = both.groupBy("row").agg(F.first("line", ignorenulls=True).alias("line"), *keys)
    found = [F.col(f"k{i}").cast(kind).alias(x.name) for i, (x, kind) in enumerate(zip(lookups, kinds))]
    return back.select("line.*", *found)


def resolve_keys(
    df: DataFrame, lookups: Sequence[Lookup], spread: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys, and rows with at least one missing.

    The two are complementary filters of one joined frame.
    """
    found = resolve_all(df, lookups, spread)
    missing = unresolved(lookups)
    return found.filter(~missing), found.filter(missing)


def fact_insert(valid: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Current fact versions of resolved rows."""
    return valid.select(
        "*",
        ts_lit(run_ts).alias("date_active_from"),
        ts_lit(FACT_OPEN_END).alias("date_active_to"),
        F.lit(1).alias("dw_current"),
    )


def fact_quarantine(rejected: DataFrame, run_id: int, run_ts: str | dt.datetime) -> DataFrame:
    """Error rows: keys found so far, raw ids, run id and status."""
    return rejected.select(
        F.lit(run_id).alias("runid"),
        "*",
        F.lit(RECORD_ERROR).alias("record_status"),
        ts_lit(run_ts).alias("dw_creation_date"),
    )


def fact_expire(
    fact: DataFrame,
    changed: DataFrame,
    key: Sequence[str],
    run_ts: str | dt.datetime,
    expire_offset: str = "1 DAY",
    deal: Sequence[str] = (),
) -> DataFrame:
    """Close the current version of every changed key.

    With ``deal``, columns of the key, versions and changed keys are shuffled by these and stay there.
    """
    keys = list(key)
    if deal:
        marks = changed.select(*keys).dropna().withColumn("__mark", F.lit(True))
        stacked = fact.withColumn("__mark", F.lit(False)).unionByName(marks, allowMissingColumns=True).repartition(*deal)
        marked = F.max("__mark").over(Window.partitionBy(*keys))
        joined = stacked.withColumn("__hit", F.when(marked, True)).filter(~F.col("__mark"))
    else:
        hit = changed.select(*[F.col(k).alias(f"__{k}") for k in keys], F.lit(True).alias("__hit"))
        joined = fact.join(hit, [F.col(k) == F.col(f"__{k}") for k in keys], "left")
    now = ts_lit(run_ts)
    closes = (
        F.col("__hit").isNotNull()
        & (F.col("dw_current") == 1)
        & (F.col("date_active_from") <= now)
        & (now < F.col("date_active_to"))
    )
    out = {
        "date_active_to": F.when(closes, now - F.expr(f"INTERVAL {expire_offset}")).otherwise(F.col("date_active_to")),
        "dw_current": F.when(closes, F.lit(0)).otherwise(F.col("dw_current")),
    }
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in fact.columns])


def fact_merge(
    fact: DataFrame,
    valid: DataFrame,
    diff: DataFrame,
    key: Sequence[str],
    run_ts: str | dt.datetime,
    expire_offset: str = "1 DAY",
    deal: Sequence[str] = (),
) -> DataFrame:
    """The fact after one load.

    ``valid`` are the resolved rows of new and changed keys. A changed key whose
    row could not be resolved is closed all the same; its new image waits in the
    error table. See ``fact_expire`` for ``deal``.
    """
    changed = diff.filter(F.col("op") == UPDATE).select(*key)
    kept = fact_expire(fact, changed, key, run_ts, expire_offset, deal)
    return kept.unionByName(fact_insert(valid, run_ts).select(*fact.columns))


def moved_rows(changes: DataFrame, ops: Sequence[str] = (INSERT, UPDATE)) -> DataFrame:
    """Rows of ``fact_changes`` with one of the given kinds of change."""
    return changes.filter(F.col("op").isin(*ops)).drop("op")


def reprocess_errors(
    errors: DataFrame,
    lookups: Sequence[Lookup],
    run_id: int,
    run_ts: str | dt.datetime,
    spread: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Drive the error rows of one run again.

    Returns new fact versions of the rows that resolve now, and the error table
    with those rows marked; rows of other runs and rows resolved earlier are left
    alone.
    """
    names = [x.name for x in lookups]
    open_rows = (F.col("runid") == run_id) & (F.col("record_status") == RECORD_ERROR)
    again = resolve_all(errors.filter(open_rows).drop(*names), lookups, spread)
    missing = unresolved(lookups)
    facts = fact_insert(again.filter(~missing).drop("runid", "record_status", "dw_creation_date"), run_ts)
    marked = again.withColumn("record_status", F.when(missing, RECORD_ERROR).otherwise(RECORD_RESOLVED))
    untouched = errors.filter(~F.coalesce(open_rows, F.lit(False)))
    return facts, untouched.unionByName(marked.select(*errors.columns))


def reprocess_all_errors(
    errors: DataFrame, lookups: Sequence[Lookup], key: Sequence[str], run_ts: str | dt.datetime, spread: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Drive the open error rows of all runs again, in one pass over the lookups.

    Of the rows of a line only the one of its newest run counts, whatever became of it: open
    rows of older runs are marked superseded. The newest run of a line is a grouped maximum of
    a number, so nothing is sorted, and a line with many runs is one row per task. Returns new
    fact versions, and the error table with its marks. ``errors`` has one row per line and run.
    """
    names = [x.name for x in lookups]
    newest = errors.groupBy(*key).agg(F.max("runid").alias("__newest"))
    is_open = F.coalesce(F.col("record_status") == RECORD_ERROR, F.lit(False))
    seen = errors.join(newest, list(key), "left")
    old = F.coalesce(F.col("runid") < F.col("__newest"), F.lit(False))
    again = resolve_all(seen.filter(is_open & ~old).drop("__newest", *names), lookups, spread)
    missing = unresolved(lookups)
    facts = fact_insert(again.filter(~missing).drop("runid", "record_status", "dw_creation_date"), run_ts)
    marked = again.withColumn("record_status", F.when(missing, RECORD_ERROR).otherwise(RECORD_RESOLVED))
    status = F.when(is_open, F.lit(RECORD_SUPERSEDED)).otherwise(F.col("record_status"))
    rest = seen.filter(~is_open | old).withColumn("record_status", status)
    return facts, rest.select(*errors.columns).unionByName(marked.select(*errors.columns))
