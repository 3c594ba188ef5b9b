"""Loads of one dimension, one fact, one hierarchy, and of a whole run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields
from functools import reduce
from graphlib import TopologicalSorter
from operator import or_
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from lodestar.functions.columns import fill_blank, ts_lit
from lodestar.functions.reserved import ERROR_ID, NA_ID, NA_TEXT, RECORD_ERROR, RECORD_SUPERSEDED
from lodestar.operators.diff import (
    INSERT,
    NOCHANGE,
    UPDATE,
    count_columns,
    dim_stage_refresh,
    image_diff,
    increment_images,
    refreshed_stage,
)
from lodestar.operators.extract import incremental_extract, latest_per_key
from lodestar.operators.facts import (
    fact_insert,
    fact_merge,
    fact_quarantine,
    moved_rows,
    reprocess_errors,
    reprocess_all_errors,
    resolve_all,
    resolve_stacked,
    unresolved,
)
from lodestar.operators.hierarchy import hierarchy_tables, parent_lookup
from lodestar.operators.joins import Side, join_sides
from lodestar.operators.scd import DimSpec, default_members, scd_insert, scd_merge, seed_default_members
from lodestar.plans import control
from lodestar.plans.dimensions import ENRICHED
from lodestar.plans.facts import FactSpec
from lodestar.sources.run_store import WHOLE, Published, RunStore

#: Column of a fact's stage: what the run that wrote the row did with it; NULL for rows it only kept.
OP = "dw_op"
#: Rows of one number go to one task; a part has a number for about so many rows.
DEAL, DEAL_ROWS = "dw_deal", 50_000
#: Files that a part may lie in, per number, before its rows are dealt for writing.
NEAR_FILES = 4


@dataclass(frozen=True)
class RunContext:
    """Where and when a run takes place. Equal contexts give equal results."""

    store: RunStore
    run_id: int
    run_ts: str | dt.datetime
    attempt: int = 1
    subsidiary: str = ""
    expire_offset: str = "1 DAY"
    delete_scope: str = "active"

    def before(self, table: str, wanted: Callable[[str], bool] | None = None) -> DataFrame | None:
        """State of a table, or of some parts, that this run starts from."""
        return self.store.read(table, self.run_id, wanted)

    def latest(self, table: str, wanted: Callable[[str], bool] | None = None) -> DataFrame | None:
        """State of a table with what earlier attempts of this run have published."""
        return self.store.read(table, self.run_id + 1, wanted)

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
        return self.store.write(df, table, self.run_id, self.attempt, partition_by, dealt)

    def scratch(self, df: DataFrame, table: str) -> DataFrame:
        """Write rows that only the load itself reads; those of the next load take their place."""
        return self.store.write_to(df, f"{self.store.root}/{table}/scratch")

    def path(self, table: str) -> str:
        return self.store.path(table, self.run_id, self.attempt)

    def whole(self, df: DataFrame, table: str) -> dict[str, Published]:
        """Write a table that replaces its last state."""
        self.write(df, table)
        return {table: Published({WHOLE: self.path(table)})}

    def append(self, df: DataFrame, table: str) -> dict[str, Published]:
        """Write rows that join what is there."""
        self.write(df, table)
        return {table: Published({f"run{self.run_id}": self.path(table)}, ())}


@dataclass(frozen=True)
class ReplayContext(RunContext):
    """An earlier run loaded again: it starts from ``state`` and writes below the run that replays it."""

    state: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    folder: str = ""

    def before(self, table: str, wanted: Callable[[str], bool] | None = None) -> DataFrame | None:
        return self.store.read_parts(self.state.get(table, {}), wanted)

    latest = before

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
        return self.store.write_to(df, self.path(table), partition_by, dealt)

    def path(self, table: str) -> str:
        return f"{self.store.root}/{table}/{self.folder}"


Loaded = tuple[dict[str, Published], DataFrame]


def _empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def enrich(spec: DimSpec, prestage: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Add the parent and class names a dimension takes along."""
    sides = [
        Side(tables[table], [(F.col(fk), key)], take) for table, fk, key, take in ENRICHED.get(spec.name, ())
    ]
    if not sides:
        return prestage
    out = join_sides(prestage, sides)
    names = [n for s in sides for n in s.take]
    return out.withColumns({n: fill_blank(n, NA_TEXT) for n in names})


def _observed(seen: Observation, names: Sequence[str]) -> dict[str, int]:
    """Counts seen by an action; zeros where Spark found the rows to be none and left the counting out of the plan."""
    try:
        return dict(seen.get)
    except Py4JJavaError as e:
        if "AssertionError" not in str(e):
            raise
        return dict.fromkeys(names, 0)


def _write_moved(ctx: RunContext, diff: DataFrame, table: str) -> tuple[DataFrame, dict[str, int]]:
    """Write the keys that moved and count all of them in the same pass."""
    seen = Observation()
    moved = ctx.write(diff.observe(seen, *count_columns()).filter(F.col("op") != NOCHANGE), table)
    return moved, _observed(seen, diff.agg(*count_columns()).columns)


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _reject_null_keys(ctx: RunContext, name: str, rows: DataFrame, keys: Sequence[str]) -> tuple[dict[str, Published], int]:
    """Rows without a key go to the rejected rows of the entity, with the reason."""
    seen = Observation()
    lost = rows.filter(_null_key(keys)).select(
        F.lit(ctx.run_id).alias("runid"), "*", F.lit("null key").alias("reason"), ts_lit(ctx.run_ts).alias("dw_creation_date")
    )
    published = ctx.append(lost.observe(seen, F.count(F.lit(1)).alias("n")), f"{name}_rejected")
    return published, _observed(seen, ["n"])["n"]


def _counted(ctx: RunContext, counts: Mapping[str, int], received: int, null_keys: int) -> DataFrame:
    """Counts of a delta next to what was received; nothing may be left unexplained."""
    told = {**counts, "received": received, "null_keys": null_keys, "duplicates": received - null_keys - counts["ingested"]}
    if told["duplicates"] < 0:
        raise ValueError(f"more keys compared than rows received: {told}")
    return ctx.store.spark.createDataFrame([tuple(told.values())], ", ".join(f"{c} bigint" for c in told))


def load_dimension(
    ctx: RunContext,
    spec: DimSpec,
    prestage: DataFrame,
    order: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    seed: bool = False,
) -> Loaded:
    """Compare, refresh the stage image and merge the dimension.

    The moved keys are written once and feed everything else. Name a modification
    time in ``order`` if the source may hold a key more than once. Rows without a key are
    kept as rejected rows and counted, as are surplus rows of a key. With ``tables`` the
    names that the dimension takes from parents and classes are added first. ``seed`` adds
    the 'not available' and 'in error' members where they are missing. A dimension in
    buckets is merged in the touched ones only; its image is compared as a whole. Returns
    what to publish and the counts of the delta.
    """
    if tables is not None:
        prestage = enrich(spec, prestage, tables)
    prestage = prestage.select(*dict.fromkeys([spec.key, *spec.attributes, *([order] if order else [])]))
    seen = Observation()
    rows = prestage
    if order is not None:
        rows = ctx.write(prestage, f"prestage_{spec.name}")
    rejected, null_keys = _reject_null_keys(ctx, spec.name, rows, [spec.key])
    if order is not None:
        received = rows.count()
        rows = latest_per_key(rows.filter(~_null_key([spec.key])), spec.key, order)
    else:
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    prestage = rows.select(spec.key, *spec.attributes)
    _refuse_other_parts(ctx, spec)
    stage = ctx.before(f"stage_{spec.name}")
    stage = _empty_like(prestage) if stage is None else stage
    images = image_diff(prestage, stage, spec.key, spec.scd1, spec.scd2).select(spec.key, "op", "ch_type", "new")
    moved, counts = _write_moved(ctx, images, f"delta_{spec.name}")
    told = _counted(ctx, counts, received if order is not None else _observed(seen, ["n"])["n"], null_keys)
    if spec.buckets:
        return {**rejected, **_merge_buckets(ctx, spec, _empty_like(prestage), moved, seed)}, told
    dim = ctx.before(spec.name)
    staged = ctx.whole(dim_stage_refresh(stage, moved, spec.key), f"stage_{spec.name}")
    if dim is None:
        merged = scd_insert(moved, spec, ctx.run_ts, None, None)
    else:
        merged = scd_merge(dim, moved, spec, ctx.run_ts, ctx.expire_offset, ctx.delete_scope)
    if seed:
        merged = seed_default_members(merged, default_members(spec, merged), spec.target(spec.key))
    # the image of the run, should it be replayed: the stage as it is now, nothing is written twice
    received = {f"received_{spec.name}": Published({f"run{ctx.run_id}": ctx.path(f"stage_{spec.name}")}, ())}
    return {**received, **staged, **rejected, **ctx.whole(merged, spec.name)}, told


def _refuse_other_parts(ctx: RunContext, spec: DimSpec) -> None:
    """The parts of a dimension and the way its keys are numbered stay as they were at its first load."""
    end = f"of{spec.buckets}" if spec.buckets else WHOLE
    odd = [p for p in ctx.store.published(ctx.run_id).get(spec.name, {}) if not p.endswith(end)]
    if odd:
        raise ValueError(f"{spec.name} is kept in other parts: {sorted(odd)[:3]}")


def _merge_buckets(
    ctx: RunContext, spec: DimSpec, empty: DataFrame, moved: DataFrame, seed: bool
) -> dict[str, Published]:
    """Stage image and dimension of the parts that hold moved keys; the others stay as they are, unread.

    ``seed`` takes in the two parts of the default members.
    """
    touched = _touched(spec, moved)
    stage = ctx.before(f"stage_{spec.name}", set(touched).__contains__)
    refreshed = dim_stage_refresh(empty if stage is None else stage, moved, spec.key)
    staged = _write_parts(ctx, spec, f"stage_{spec.name}", refreshed, touched)
    if seed:
        ids = F.array(*[F.lit(i).cast(empty.schema[spec.key].dataType) for i in (NA_ID, ERROR_ID)])
        touched = sorted({*touched, *_touched(spec, empty.sparkSession.range(1).select(F.explode(ids).alias(spec.key)))})
    dim = ctx.before(spec.name, set(touched).__contains__)
    if dim is None:
        merged = scd_insert(moved, spec, ctx.run_ts, None, None)
    else:
        merged = scd_merge(dim, moved, spec, ctx.run_ts, ctx.expire_offset, ctx.delete_scope)
    if seed:
        merged = seed_default_members(merged, default_members(spec, merged), spec.target(spec.key))
    return {**staged, **_write_parts(ctx, spec, spec.name, merged, touched)}


def _touched(spec: FactSpec | DimSpec, rows: DataFrame) -> list[str]:
    # As many values as there are parts, which the part width or the number of buckets bounds.
    return [r[0] for r in rows.select(spec.part().alias("p")).distinct().collect() if r[0] is not None]


def _write_parts(
    ctx: RunContext, spec: FactSpec | DimSpec, table: str, rows: DataFrame, touched: Sequence[str], dealt: bool = False
) -> dict[str, Published]:
    """Write the touched parts of a table anew."""
    written = ctx.write(rows.withColumn("dw_part", spec.part()), table, ["dw_part"], dealt)
    parts = [r[0] for r in written.select("dw_part").distinct().collect()]
    return {table: Published({p: f"{ctx.path(table)}/dw_part={p}" for p in parts}, touched)}


def _slots(spec: FactSpec, *tables: DataFrame) -> int:
    """Numbers that each part gets, from the rows of the largest one."""
    most = [t.groupBy(spec.part().alias("p")).count().agg(F.max("count")).first()[0] or 0 for t in tables]
    return max(1, -(-sum(most) // DEAL_ROWS))


def _numbered(spec: FactSpec, rows: DataFrame, slots: int) -> DataFrame:
    """Rows with the number they are dealt by: tables dealt alike meet by number and key and are written by part where they are."""
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in spec.key]), F.lit(slots))
    return rows.withColumn(DEAL, F.hash(spec.part(), slot))


def _near(spec: FactSpec, written: DataFrame, places: int) -> bool:
    """Whether the rows of a part lie in a few files, so that they can be written by part from where they are."""
    met = written.select(F.input_file_name().alias("file"), spec.part().alias("part")).distinct().count()
    return met <= NEAR_FILES * places


def _write_fact(
    ctx: RunContext, spec: FactSpec, fact: DataFrame, touched: Sequence[str], dealt: bool = False
) -> dict[str, Published]:
    """Write the current versions of the touched parts anew and add the versions just closed."""
    state = F.when(F.col("dw_current") == 1, "current").otherwise("closed")
    rows = fact.withColumns({"dw_state": state, "dw_part": spec.part()})
    written = ctx.write(rows, spec.name, ["dw_state", "dw_part"], dealt)
    paths = {}
    for r in written.select("dw_state", "dw_part").distinct().collect():
        name = f"current/{r[1]}" if r[0] == "current" else f"closed/{r[1]}/run{ctx.run_id}"
        paths[name] = f"{ctx.path(spec.name)}/dw_state={r[0]}/dw_part={r[1]}"
    return {spec.name: Published(paths, [f"current/{p}" for p in touched])}


def _current(ctx: RunContext, spec: FactSpec, touched: Sequence[str]) -> DataFrame | None:
    names = {f"current/{p}" for p in touched}
    return ctx.before(spec.name, names.__contains__)


def load_fact(
    ctx: RunContext,
    spec: FactSpec,
    prestage: DataFrame,
    dims: Mapping[str, DataFrame],
    order: str = "date_last_modified",
    stored: str | None = None,
) -> Loaded:
    """Compare an increment, resolve its new and changed lines once, load or quarantine.

    The increment is written first, so its source is queried once; ``stored`` names the folder of one that the
    store has already. Only the parts of stage and fact that hold its keys are read and rewritten; closed versions and
    error rows are appended. Increment, stage and current versions are dealt by part once each: the latest image of a
    line, its comparison, the next stage and the closing of versions happen there, and parts are written from there.
    The stage says what became of each line, so new and changed ones are read off it. The resolved rows are written
    where the lookups left them, so the fact and the error table read their share without repeating the lookups, and
    make room for those of the next load; rows that no lookup has shuffled still lie by part and go to the fact as they are.
    """
    keys = list(spec.key)
    if stored is None:
        received = ctx.append(prestage, f"received_{spec.name}")
        stored = ctx.path(f"received_{spec.name}")
    else:
        received = {f"received_{spec.name}": Published({f"run{ctx.run_id}": stored}, ())}
    raw = ctx.store.spark.read.schema(prestage.schema).parquet(stored)
    rejected, null_keys = _reject_null_keys(ctx, spec.name, raw, keys)
    known = raw.filter(~_null_key(keys))
    touched = _touched(spec, known)
    stage = ctx.before(f"stage_{spec.name}", set(touched).__contains__)
    stage = _empty_like(known) if stage is None else stage.drop(OP)
    columns, compared = stage.columns, spec.compared(known.columns)
    if set(columns) != set(known.columns):
        raise ValueError(f"{spec.name}: increment and stage differ in {sorted(set(columns) ^ set(known.columns))}")
    compared = [c for c in columns if c not in keys] if compared is None else compared
    slots = _slots(spec, known, stage)
    numbered = [_numbered(spec, rows, slots) for rows in (known, stage)]
    images = increment_images(*numbered, [DEAL, *keys], order, compared, [DEAL])
    seen = Observation()
    refreshed = refreshed_stage(images, columns, F.when(F.col("in_prestage"), F.col("op")).alias(OP))
    refreshed = refreshed.observe(seen, *count_columns(OP))
    staged = _write_parts(ctx, spec, f"stage_{spec.name}", refreshed, touched, dealt=True)
    counts = _observed(seen, refreshed.agg(*count_columns(OP)).columns)
    written = ctx.store.spark.read.schema(refreshed.schema).parquet(ctx.path(f"stage_{spec.name}"))
    changes = written.withColumnRenamed(OP, "op").filter(F.col("op").isin(INSERT, UPDATE))

    lookups = spec.bind(dims, ctx.run_ts)
    resolve = resolve_stacked if spec.stacked else resolve_all
    found = resolve(spec.lines(moved_rows(changes)), lookups).withColumn("rejected", unresolved(lookups))
    found = ctx.scratch(found, f"resolved_{spec.name}")
    near = _near(spec, found, len(touched) * slots)
    valid = spec.shape(found.filter(~F.col("rejected")).drop("rejected"))
    valid = _numbered(spec, valid, slots)
    valid = valid if near else valid.repartition(DEAL)
    errors = fact_quarantine(found.filter(F.col("rejected")).drop("rejected"), ctx.run_id, ctx.run_ts)

    fact = _current(ctx, spec, touched)
    if fact is None:
        merged = fact_insert(valid, ctx.run_ts)
    else:
        known_fact, updates = _numbered(spec, fact, slots), _numbered(spec, changes.select(*keys, "op"), slots)
        merged = fact_merge(known_fact, valid, updates, [DEAL, *keys], ctx.run_ts, ctx.expire_offset, [DEAL])
    loaded = _write_fact(ctx, spec, merged.drop(DEAL), touched, dealt=True)
    told = _counted(ctx, counts, raw.count(), null_keys)
    return {**received, **staged, **loaded, **rejected, **ctx.append(errors, f"{spec.name}_error")}, told


def supersede_errors(
    errors: DataFrame, later: DataFrame | None, fact: DataFrame | None, keys: list[str]
) -> DataFrame:
    """Mark open error rows whose line was quarantined again or loaded afterwards."""
    rows, gone = errors, F.lit(False)
    if later is not None:
        rows = rows.join(later.select(*keys).distinct().withColumn("__again", F.lit(True)), keys, "left")
        gone = gone | F.col("__again").isNotNull()
    if fact is not None:
        current = fact.filter(F.col("dw_current") == 1)
        rows = rows.join(current.select(*keys, F.col("date_active_from").alias("__loaded")), keys, "left")
        gone = gone | F.coalesce(F.col("__loaded") > F.col("dw_creation_date"), F.lit(False))
    is_open = F.col("record_status") == RECORD_ERROR
    status = F.when(is_open & gone, F.lit(RECORD_SUPERSEDED)).otherwise(F.col("record_status"))
    return rows.withColumn("record_status", status).select(*errors.columns)


def reprocess_fact(ctx: RunContext, spec: FactSpec, dims: Mapping[str, DataFrame], error_run: int) -> Loaded:
    """Drive the quarantined rows of an earlier run into the fact.

    A row whose line has come again since, quarantined or loaded, is superseded: it
    is marked so and stays out of the fact. When a row lands, an older current
    version of its line is closed.
    """
    table, part = f"{spec.name}_error", f"run{error_run}"
    mine = ctx.before(table, part.__eq__)
    if mine is None:
        raise ValueError(f"run {error_run} left no errors of {spec.name}")
    later = ctx.before(table, lambda p: int(p.removeprefix("run")) > error_run)
    keys = list(spec.key)
    touched = _touched(spec, mine)
    fact = _current(ctx, spec, touched)
    errors = ctx.write(supersede_errors(mine, later, fact, keys), f"open_{table}")
    facts, marked = reprocess_errors(errors, spec.bind(dims, ctx.run_ts), error_run, ctx.run_ts)
    loaded, counts = _land(ctx, spec, facts, fact, touched)
    ctx.write(marked, table)
    return {**loaded, table: Published({part: ctx.path(table)}, (part,))}, counts


def _land(
    ctx: RunContext, spec: FactSpec, facts: DataFrame, fact: DataFrame | None, touched: Sequence[str]
) -> Loaded:
    """The fact with re-driven rows, each closing an older current version of its line."""
    keys = list(spec.key)
    resolved = ctx.write(spec.shape(facts), f"resolved_{spec.name}")
    if fact is None:
        merged = resolved
    else:
        diff = resolved.select(*keys, F.lit(UPDATE).alias("op"))
        valid = resolved.drop("date_active_from", "date_active_to", "dw_current")
        merged = fact_merge(fact, valid, diff, keys, ctx.run_ts, ctx.expire_offset)
    loaded = _write_fact(ctx, spec, merged, touched)
    return loaded, resolved.agg(F.count(F.lit(1)).alias("resolved"))


def reprocess_all(ctx: RunContext, spec: FactSpec, dims: Mapping[str, DataFrame]) -> Loaded:
    """Drive the open error rows of all earlier runs into the fact.

    Only the newest row of a line is driven; older ones, and those whose line has been
    loaded since, are marked superseded. Error rows are rewritten for the runs that have
    open ones; closed runs are read for their keys alone.
    """
    table = f"{spec.name}_error"
    errors = ctx.before(table)
    if errors is None:
        raise ValueError(f"no run left errors of {spec.name}")
    open_rows = errors.filter(F.col("record_status") == RECORD_ERROR)
    runs = [r[0] for r in open_rows.select("runid").distinct().orderBy("runid").collect()]  # one number per run
    keys = list(spec.key)
    touched = _touched(spec, open_rows)
    fact = _current(ctx, spec, touched)
    errors = ctx.write(supersede_errors(errors, None, fact, keys), f"open_{table}")
    facts, marked = reprocess_all_errors(errors, spec.bind(dims, ctx.run_ts), keys, ctx.run_ts)
    loaded, counts = _land(ctx, spec, facts, fact, touched)
    ctx.write(marked.filter(F.col("runid").isin(runs)).withColumn("dw_run", F.col("runid")), table, ["dw_run"])
    parts = {f"run{r}": f"{ctx.path(table)}/dw_run={r}" for r in runs}
    return {**loaded, table: Published(parts, tuple(parts))}, counts


def _replay(
    ctx: RunContext, tables: Sequence[str], runs: Sequence[RunContext], load: Callable[[ReplayContext, RunContext], Loaded]
) -> Loaded:
    """Load ``runs`` again one after the other, the first from the state before it; the counts are the first one's."""
    base = ctx.store.published(runs[0].run_id)
    state = {t: base.get(t, {}) for t in tables}
    counts = None
    for run in runs:
        folder = f"run{ctx.run_id}/attempt{ctx.attempt}/replay{run.run_id}"
        settings = {f.name: getattr(run, f.name) for f in fields(RunContext)}
        written, told = load(ReplayContext(**settings | {"store": ctx.store}, state=state, folder=folder), run)
        state |= {t: change.applied(state.get(t, {})) for t, change in written.items()}
        counts = told if counts is None else counts
    return {t: Published(parts) for t, parts in state.items()}, counts


def _received(ctx: RunContext, table: str, runs: Sequence[RunContext]) -> tuple[list[RunContext], dict[str, str]]:
    """``runs`` in order, and what they have received; the first and all later loads have to be among them."""
    runs = sorted(runs, key=lambda r: r.run_id)
    parts = ctx.store.published(ctx.run_id).get(table, {})
    want = [r for r in sorted(int(p.removeprefix("run")) for p in parts) if r >= runs[0].run_id]
    if [r.run_id for r in runs] != want:
        raise ValueError(f"a replay from run {runs[0].run_id} takes the runs {want} of {table}")
    return runs, parts


def replay_dimension(
    ctx: RunContext, spec: DimSpec, runs: Sequence[RunContext], prestage: DataFrame, **options: Any
) -> Loaded:
    """Load an older run of a dimension anew from ``prestage`` and the later ones on top of it.

    ``runs`` are the contexts of the older run and of every later load of the dimension. The later
    images are the stages of their runs, so no source is asked again; ``options`` go to
    :func:`load_dimension` for the older run, and ``seed`` for all. The result is that
    of the runs in their order with the right image in place of the first, surrogate keys
    included. It is published as part of the run of ``ctx``; facts loaded since keep their keys.
    A dimension in buckets keeps no image of a run of its own and is refused.
    """
    if spec.buckets:
        raise ValueError(f"{spec.name} is kept in buckets, its runs cannot be replayed")
    received = f"received_{spec.name}"
    runs, parts = _received(ctx, received, runs)

    def load(again: ReplayContext, run: RunContext) -> Loaded:
        if run is runs[0]:
            return load_dimension(again, spec, prestage, **options)
        rows = ctx.store.read_parts(parts, f"run{run.run_id}".__eq__)
        return load_dimension(again, spec, rows, seed=options.get("seed", False))

    return _replay(ctx, (received, f"stage_{spec.name}", spec.name, f"{spec.name}_rejected"), runs, load)


def replay_fact(
    ctx: RunContext,
    spec: FactSpec,
    runs: Sequence[RunContext],
    prestage: DataFrame,
    dims: Callable[[RunContext], Mapping[str, DataFrame]],
    order: str = "date_last_modified",
) -> Loaded:
    """Load an older run of a fact anew from ``prestage``, and the increments received since on top of it.

    ``runs`` are the contexts of the older run and of every later load of the fact, ``dims`` gives
    the dimensions a run looks keys up in (``store.read(name, run_id + 1)`` for those of its time). Errors that were
    driven again since are open once more: :func:`reprocess_all` drives them.
    """
    received = f"received_{spec.name}"
    runs, parts = _received(ctx, received, runs)

    def load(again: ReplayContext, run: RunContext) -> Loaded:
        if run is runs[0]:
            return load_fact(again, spec, prestage, dims(run), order)
        stored = f"run{run.run_id}"
        return load_fact(again, spec, ctx.store.read_parts(parts, stored.__eq__), dims(run), order, parts[stored])

    tables = (received, f"stage_{spec.name}", spec.name, f"{spec.name}_error", f"{spec.name}_rejected")
    return _replay(ctx, tables, runs, load)


def load_hierarchy(
    ctx: RunContext,
    name: str,
    prestage: DataFrame,
    key: str,
    parent: str,
    own: Sequence[str],
    parent_attrs: Mapping[str, tuple[str, str]],
    root_level: int | None = None,
) -> dict[str, Published]:
    """Edges with parent attributes, depths, and the ancestor closure.

    ``own`` are the node's loaded columns. ``parent_attrs`` maps an edge column to
    (column read from the parent row, own column shown on the self row).
    """
    edges = parent_lookup(
        prestage.select(key, *own, parent, *[c for c, _ in parent_attrs.values() if c not in (key, parent, *own)]),
        key, parent, {out: source for out, (source, _) in parent_attrs.items()},
    ).select(key, *own, parent, *parent_attrs)
    edges = ctx.write(edges, f"{name}_edges")
    shown = {out: own_col for out, (_, own_col) in parent_attrs.items()}
    depth, closure = hierarchy_tables(edges, key, parent, shown, root_level)
    depths = ctx.whole(depth, f"{name}_depth")
    read_back = Published({WHOLE: ctx.path(f"{name}_edges")})
    return {f"{name}_edges": read_back, **depths, **ctx.whole(closure, f"{name}_hierarchy")}


@dataclass
class Job:
    """One entity of a run: a name and the call that loads it.

    ``watermark`` names the fact and the interval it was extracted for; without a start
    the interval begins at the watermark itself. ``needs`` are the entities it uses; without them a
    fact is taken to use every dimension of the run, a dimension nothing.
    """

    entity: str
    load: Callable[[RunContext], Loaded]
    is_dimension: bool = True
    watermark: tuple[str, str | dt.datetime | None, str | dt.datetime] | None = None
    needs: Sequence[str] | None = None


def _watermark_before(ctx: RunContext, fact: str) -> dt.datetime:
    """Watermark that a run starts from, also when an earlier attempt has moved it."""
    watermarks = ctx.before("watermarks")
    if watermarks is None:
        raise control.MissingWatermark(f"no watermarks at all, {fact} needs one")
    return control.watermark_value(watermarks, fact, ctx.subsidiary)


def increment_job(
    spec: FactSpec,
    source: Callable[[], DataFrame],
    ts_cols: str | Sequence[str],
    dims: Callable[[RunContext], Mapping[str, DataFrame]],
    end: str | dt.datetime,
    filters: Mapping[str, Any] | None = None,
) -> Job:
    """Read the watermark, extract what changed since, load it, and move the watermark to ``end``."""

    def load(ctx: RunContext) -> Loaded:
        rows = incremental_extract(source(), ts_cols, _watermark_before(ctx, spec.name), filters)
        return load_fact(ctx, spec, rows, dims(ctx))

    return Job(spec.name, load, is_dimension=False, watermark=(spec.name, None, end))


@dataclass
class RunResult:
    status: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    published: dict[str, Published] = field(default_factory=dict)


def _in_order(jobs: Sequence[Job]) -> list[tuple[Job, list[str]]]:
    """Jobs after what they need, each with those of its needs that are part of the run; dimensions first."""
    by = {j.entity: j for j in [*[j for j in jobs if j.is_dimension], *[j for j in jobs if not j.is_dimension]]}
    dimensions = [e for e, j in by.items() if j.is_dimension]
    default = {True: [], False: dimensions}
    needs = {e: [n for n in (default[j.is_dimension] if j.needs is None else j.needs) if n in by] for e, j in by.items()}
    return [(by[e], needs[e]) for e in TopologicalSorter(needs).static_order()]


def run_jobs(ctx: RunContext, jobs: Sequence[Job], entities: Sequence[str] | None = None, mode: str = "normal") -> RunResult:
    """Load entities in order and publish what they wrote together with the logs.

    A failing entity does not stop the others, only those that need it, directly or by
    way of others (:class:`Job`). Watermarks move only for facts that were loaded, and in the
    same publication; a fact without a watermark entry fails before it is loaded.
    ``entities`` restricts the run. With the id of the newest run and a further attempt
    it repeats part of it: those entities start from the state before the run, the others
    keep what the run has published. A run that a later one has built on is refused.
    """
    ctx.store.refuse_old_run(ctx.run_id)
    result = RunResult()
    messages: list[DataFrame] = []
    wanted = [j for j in jobs if entities is None or j.entity in entities]
    watermarks = ctx.latest("watermarks")
    times: dict[str, tuple[dt.datetime, dt.datetime]] = {}
    for job, needs in _in_order(wanted):
        failed = [n for n in needs if result.status[n] == control.ERROR]
        if failed:
            result.status[job.entity] = control.ERROR
            result.errors[job.entity] = f"not loaded: {', '.join(failed)} failed"
            continue
        started = _now()
        try:
            if job.watermark is not None:
                begin = _watermark_before(ctx, job.watermark[0])
            written, counts = job.load(ctx)
        except Exception as e:  # noqa: BLE001 - the entity is logged as failed, the run goes on
            result.status[job.entity] = control.ERROR
            result.errors[job.entity] = str(e)
            continue
        finally:
            times[job.entity] = (started, _now())
        result.status[job.entity] = control.SUCCESS
        result.published |= written
        messages.append(control.message_rows(counts, ctx.run_id, job.entity, ctx.subsidiary, ctx.run_ts))
        if job.watermark is not None:
            fact, start, end = job.watermark
            watermarks = control.watermark_advance(watermarks, fact, ctx.subsidiary, begin if start is None else start, end)
    _write_logs(ctx, result, messages, watermarks, mode, times)
    ctx.store.publish(ctx.run_id, result.published, ctx.attempt)
    return result


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def _write_logs(
    ctx: RunContext,
    result: RunResult,
    messages: Sequence[DataFrame],
    watermarks: DataFrame | None,
    mode: str,
    times: Mapping[str, tuple[dt.datetime, dt.datetime]],
) -> None:
    spark = ctx.store.spark
    rows = [
        {
            "job_id": i, "runid": ctx.run_id, "entity": entity, "run_mode": mode,
            "job_status": control.ERROR if status == control.ERROR else control.IN_PROGRESS,
            "subsidiary_id": ctx.subsidiary,
            "loadstart": times.get(entity, (None, None))[0], "loadend": times.get(entity, (None, None))[1],
        }
        for i, (entity, status) in enumerate(result.status.items(), 1)
    ]
    logged = control.final_status(control.job_rows(spark, rows))
    notes = spark.createDataFrame([], control.MESSAGE_LOG_SCHEMA)
    for m in messages:
        notes = notes.unionByName(m)
    part = f"run{ctx.run_id}".__eq__
    for table, rows, entity in (("job_log", logged, "entity"), ("message_log", notes, "target_table")):
        earlier = ctx.latest(table, part)
        if earlier is not None:  # entities that this attempt did not touch
            rows = rows.unionByName(earlier.filter((F.col("runid") == ctx.run_id) & ~F.col(entity).isin(*result.status)))
        result.published |= ctx.append(rows, table)
    if watermarks is not None:
        result.published |= ctx.whole(watermarks, "watermarks")


def seed_watermarks(ctx: RunContext, entries: Mapping[str, str | dt.datetime]) -> None:
    """First watermark of each fact, published as a run of its own."""
    rows = [(fact, ctx.subsidiary, None, None) for fact in entries]
    out = ctx.store.spark.createDataFrame(rows, control.WATERMARK_SCHEMA)
    for fact, ts in entries.items():
        out = out.withColumn("ext_end_dt", F.when(F.col("fact_name") == fact, ts_lit(ts)).otherwise(F.col("ext_end_dt")))
    ctx.write(out, "watermarks")
    ctx.store.publish(ctx.run_id, ["watermarks"], ctx.attempt)

