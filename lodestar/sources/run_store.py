"""Tables kept as parts written by runs, published together.

A load writes new folders only and then a manifest that says which folders make up
each table. Readers follow the newest manifest, so stage, dimension, fact, error
table and watermark change in one step, nothing is overwritten while it is read,
and a run that dies leaves the last published state in place.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodestar.session import shuffles_dropped

WHOLE = "whole"


class LaterRunExists(ValueError):
    """A run was to be repeated after another had been published on top of it."""


@dataclass(frozen=True)
class Published:
    """Folders a run contributes to a table, by part name.

    ``replaces`` lists the parts that go away; None means all of them.
    """

    paths: Mapping[str, str]
    replaces: Sequence[str] | None = None


    def applied(self, parts: Mapping[str, str]) -> dict[str, str]:
        """Parts of the table after this change of ``parts``."""
        kept = {} if self.replaces is None else parts
        return {p: path for p, path in kept.items() if p not in (self.replaces or ())} | dict(self.paths)


@dataclass(frozen=True)
class RunStore:
    """Tables under ``root``, a folder all executors share."""

    spark: SparkSession
    root: str

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/manifest")
        except AnalysisException:
            return None  # nothing was ever published

    def _state(self, found: DataFrame | None) -> dict[str, dict[str, str]]:
        """Parts of every table in the newest of the given manifests."""
        newest = None if found is None else found.agg(F.max(F.struct("runid", "attempt")).alias("m")).first()["m"]
        state: dict[str, dict[str, str]] = {}
        if newest is not None:
            for r in found.filter((F.col("runid") == newest[0]) & (F.col("attempt") == newest[1])).collect():
                state.setdefault(r["table_name"], {})[r["part"]] = r["path"]
        return state

    def published(self, before: int | None = None) -> dict[str, dict[str, str]]:
        """Parts of every table as of the newest run, or the newest one below ``before``."""
        found = self._manifests()
        return self._state(found if found is None or before is None else found.filter(F.col("runid") < before))

    def own(self, run_id: int) -> dict[str, dict[str, str]]:
        """What the newest attempt of a run has published; empty before the first."""
        found = self._manifests()
        return self._state(None if found is None else found.filter(F.col("runid") == run_id))

    def refuse_old_run(self, run_id: int) -> None:
        """A run can be repeated until a later one has built on it."""
        found = self._manifests()
        newest = None if found is None else found.agg(F.max("runid")).first()[0]
        if newest is not None and newest > run_id:
            raise LaterRunExists(f"run {newest} has been published after run {run_id}")

    def next_attempt(self, run_id: int) -> int:
        found = self._manifests()
        last = None if found is None else found.filter(F.col("runid") == run_id).agg(F.max("attempt")).first()[0]
        return (last or 0) + 1

    def read(
        self, table: str, before: int | None = None, wanted: Callable[[str], bool] | None = None
    ) -> DataFrame | None:
        """The published state of a table or of some of its parts; None if there is nothing."""
        return self.read_parts(self.published(before).get(table, {}), wanted)

    def read_parts(self, parts: Mapping[str, str], wanted: Callable[[str], bool] | None = None) -> DataFrame | None:
        paths = [path for part, path in sorted(parts.items()) if wanted is None or wanted(part)]
        return self.spark.read.parquet(*paths) if paths else None

    def path(self, table: str, run_id: int, attempt: int = 1) -> str:
        return f"{self.root}/{table}/run{run_id}/attempt{attempt}"

    def write(
        self, df: DataFrame, table: str, run_id: int, attempt: int = 1, partition_by: Sequence[str] = (), dealt: bool = False
    ) -> DataFrame:
        """Write the rows of a run and read them back, which also cuts their lineage.

        With ``partition_by`` the rows are rebalanced by those columns first: few files
        per folder, and a large folder is still written by several tasks. Rows that are
        ``dealt`` so already are written where they are.
        """
        return self.write_to(df, self.path(table, run_id, attempt), partition_by, dealt)

    def write_to(self, df: DataFrame, path: str, partition_by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
        rows = df.hint("rebalance", *partition_by) if partition_by and not dealt else df
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(
        self, run_id: int, tables: Mapping[str, Published] | Sequence[str], attempt: int = 1, amend: bool = False
    ) -> None:
        """Make what a run has written visible.

        A list of names publishes whole tables. Each changed table builds on its state
        before the run, or with ``amend`` on the run's own; the other tables keep what
        earlier attempts of the run have published.
        """
        self.refuse_old_run(run_id)
        if not isinstance(tables, Mapping):
            tables = {t: Published({WHOLE: self.path(t, run_id, attempt)}) for t in tables}
        before = self.published(run_id)
        state = before | self.own(run_id)
        for name, change in tables.items():
            state[name] = change.applied((state if amend else before).get(name, {}))
        rows = [(name, part, path) for name, parts in state.items() for part, path in parts.items()]
        manifest = self.spark.createDataFrame(rows, "table_name string, part string, path string")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/runid={run_id}/attempt={attempt}")


def compact(
    store: RunStore,
    table: str,
    files: int,
    run_id: int,
    failed: int,
    cluster_by: Sequence[str] = (),
    prefix: str | None = None,
) -> bool:
    """Rewrite a published table into ``files`` files per part, only after a clean run.

    Parts keep their names, so later loads find them. Of the closed versions of a fact
    the pieces that single runs have left are merged, part by part, into one for their
    range of runs; what was merged before stays as it is. With ``prefix`` just the parts
    named so take part. The result is a further attempt of the same run. Returns whether
    it was done.
    """
    parts = {p: x for p, x in store.published().get(table, {}).items() if prefix is None or p.startswith(prefix)}
    groups: dict[str, list[str]] = {}
    for part in sorted(parts):
        piece = re.fullmatch(r"(closed/.*)/run(\d+)", part)
        if piece is None and not part.startswith("closed/"):
            groups[part] = [part]
        elif piece is not None:
            groups.setdefault(piece[1], []).append(part)
    targets = {}
    for name, members in groups.items():
        if name.startswith("closed/"):
            if len(members) < 2:
                continue
            runs = [int(m.rpartition("/run")[2]) for m in members]
            name = f"{name}/runs{min(runs)}-{max(runs)}"
        targets[name] = members
    if failed or not targets:
        return False
    attempt = store.next_attempt(run_id)
    named = list(targets.items())
    frames = [
        store.spark.read.parquet(*[parts[m] for m in members]).withColumn("dw_piece", F.lit(i)) for i, (_, members) in enumerate(named)
    ]
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    # rows of a part go to its files by their content, or by the columns to cluster by
    spread = [c for c in rows.columns if c != "dw_piece" and not isinstance(rows.schema[c].dataType, T.MapType)]
    slot = F.pmod(F.xxhash64(*(cluster_by or spread)), F.lit(files))
    path = store.path(table, run_id, attempt)
    rows.repartition(len(named) * files, "dw_piece", slot).write.mode("overwrite").partitionBy("dw_piece").parquet(path)
    # an empty part leaves no folder and goes
    left = {r[0] for r in store.spark.read.parquet(path).select("dw_piece").distinct().collect()} if not rows.isEmpty() else set()
    paths = {name: f"{path}/dw_piece={i}" for i, (name, _) in enumerate(named) if i in left}
    old = [m for _, members in named for m in members]
    if paths:
        store.publish(run_id, {table: Published(paths, old)}, attempt, amend=True)
    return bool(paths)


def register_and_analyze(store: RunStore, tables: Mapping[str, str], failed: int) -> list[str]:
    """Register published tables (name -> catalog name) and compute their statistics.

    Only after a clean run. A table of several parts becomes a view over one analyzed
    table per part, named by its number. Returns the names that were analyzed.
    """
    if failed:
        return []
    spark, state, analyzed = store.spark, store.published(), []

    def analyze(name: str, path: str) -> None:
        spark.catalog.createTable(name, path, "parquet")
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
        analyzed.append(name)

    known = {t.name: t.tableType for t in spark.catalog.listTables()}
    for table, name in tables.items():
        for old in [t for t in known if t == name or re.fullmatch(re.escape(name) + r"__\d+", t)]:
            spark.sql(f"DROP {'VIEW' if known[old] in ('VIEW', 'TEMPORARY') else 'TABLE'} IF EXISTS {old}")
        paths = [path for _, path in sorted(state[table].items())]
        if len(paths) == 1:
            analyze(name, paths[0])
        else:
            for i, path in enumerate(paths):
                analyze(f"{name}__{i}", path)
            columns = ", ".join(f"`{c}`" for c in spark.read.parquet(*paths).columns)
            union = " UNION ALL ".join(f"SELECT {columns} FROM {name}__{i}" for i in range(len(paths)))
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {union}")
    return analyzed
