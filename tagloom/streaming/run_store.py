"""Totals as sorted runs: a batch writes its own totals, a reader adds the runs up.

``TotalsStore`` writes a whole table (or year) anew for each batch. Here a batch writes
one run of each table, as large as its own totals, and names it in the commit log:

* ``<root>/<table>/run=<r>`` is a Parquet run, sorted by the table's lookup columns, under
  a name of its own, so two writers never touch each other's files;
* a commit names a batch's runs and the ids that it covers. Of two writers one is first;
  the other reads that commit, and commits after it unless it holds the same batch or ids;
* ``table`` adds the live runs up by key: one scan of a few sorted runs and one shuffle
  with partial sums, and filters on keys reach the scan. Text that the first batch sets (a user's name) is
  taken from the run with the smallest commit;
* ``compact`` replaces ``fanout`` or more runs of one size tier by their sum, so a table has
  O(fanout * log(size)) runs and a row is rewritten O(log(size)) times. The new run counts,
  and the old ones stop counting, in one commit; if one of them is gone by then, nothing happens;
* ``vacuum`` deletes runs that were replaced, and files of killed writers, after a time that
  readers of older states need.

Results for odd input: an empty batch is committed with empty runs; a batch id that was
applied is skipped; null keys add up as one key, except where text is set by entity.
"""

from __future__ import annotations

import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.merge import SPECS, TotalsSpec
from ..sinks.writers import CLUSTER, write_table
from .commit_log import CommitLog, Folder, State
from .coverage import Conflict, figures, fits

FANOUT = 4
TIER_BYTES = 8 << 20
KEEP_SECONDS = 7 * 24 * 3600

#: Ids merged so far, as runs like the totals: only late windows read them.
ID_SPECS = {f"{kind}_ids": TotalsSpec(("id",), ()) for kind in ("posts", "comments")}
RUN_SPECS = {**SPECS, **ID_SPECS}


def add_up(rows: DataFrame, spec: TotalsSpec, keep_seq: bool = False) -> DataFrame:
    """Runs as one table: sums by key, and for each entity the text of its smallest ``_seq``."""
    if not spec.sums:
        return rows.select(*spec.keys).distinct()
    sums = rows.groupBy(*spec.keys).agg(*(F.sum(c).cast("bigint").alias(c) for c in spec.sums))
    if not spec.first:
        return sums.select(*spec.columns)
    entity = list(spec.entity or spec.keys)
    firsts = (rows.groupBy(*entity).agg(F.min(F.struct("_seq", *spec.first)).alias("_first"))
              .select(*entity, "_first.*"))
    return sums.join(firsts, entity).select(*spec.columns, *(["_seq"] if keep_seq else []))


class RunStore:
    """Totals tables under one shared folder, kept as runs (see the module)."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT, tier_bytes: int = TIER_BYTES):
        self.spark, self.root = spark, root.rstrip("/")
        self.fanout, self.tier_bytes = fanout, tier_bytes
        self.files = Folder(spark, self.root)
        self.log = CommitLog(self.files)

    # ---- reading ----
    def path(self, table: str, run: str) -> str:
        return f"{self.root}/{table}/run={run}"

    def _rows(self, name: str, runs: dict[str, dict]) -> DataFrame:
        """The rows of some runs; ``_seq`` is the commit that a row's text comes from."""
        spec = RUN_SPECS[name]
        schema = next(iter(runs.values()))["schema"] + ", run string"
        if spec.first:
            schema += ", _seq bigint"
        rows = (self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
                .parquet(*(self.path(name, run) for run in runs)))
        if not spec.first:
            return rows.drop("run")
        seqs = F.create_map(*(F.lit(v) for run, f in runs.items() for v in (run, f["seq"])))
        return rows.withColumn("_seq", F.coalesce("_seq", seqs[F.col("run")])).drop("run")

    def table(self, name: str, years: list[int] | None = None, state: State | None = None) -> DataFrame | None:
        """The current table (only the given years of a year-split one), of one state of the log."""
        runs = (state or self.log.state()).runs.get(name)
        if not runs:
            return None
        spec, rows = RUN_SPECS[name], self._rows(name, runs)
        if years is not None and spec.partition_by:
            rows = rows.where(F.col(spec.partition_by[0]).isin(*years))
        return rows.select(*spec.columns) if len(runs) == 1 else add_up(rows, spec)

    def applied(self, batch_id: str) -> bool:
        return self.log.applied(batch_id, self.log.state())

    def covered(self, kind: str) -> list[list[int]]:
        """The merged id intervals of a source."""
        return self.log.state().cover.get(kind, [])

    # ---- writing ----
    def _write_run(self, name: str, rows: DataFrame, columns: list[str], schema: str | None = None) -> tuple:
        spec, run = RUN_SPECS[name], f"r{uuid.uuid4().hex}"
        rows = rows.select(*columns)
        write_table(rows, self.path(name, run), "errorifexists", spec.partition_by,
                    CLUSTER.get(name, spec.keys))
        schema = schema or ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
        return name, run, {"bytes": self.files.bytes(f"{name}/run={run}"), "schema": schema}

    def _discard(self, added: list[tuple]) -> None:
        for name, run, _ in added:
            self.files.delete(f"{name}/run={run}")

    def apply(self, batch_id: str, deltas: dict[str, DataFrame], cover: tuple | None = None) -> bool:
        """Add a batch's totals once; False if the batch was applied before.

        ``cover`` is ``(kind, [low, high, n, x], was)``: the ids it merges. If another writer
        merged ids of that window since ``was`` was read, nothing is added and ``Conflict`` is raised.
        """
        if self.applied(batch_id):
            return False
        added = [self._write_run(name, delta, RUN_SPECS[name].columns) for name, delta in deltas.items()]
        entry = {"batch": batch_id, "add": added, "cover": cover and cover[:2]}
        while True:
            state = self.log.state()
            if self.log.applied(batch_id, state):
                self._discard(added)
                return False
            if cover and not fits(state.cover.get(cover[0], []), *cover[1][:2], cover[2]):
                self._discard(added)
                raise Conflict(f"{cover[0]} {cover[1][:2]}")
            if self.log.commit(state, entry):
                return True

    def merge_window(self, kind: str, rows: DataFrame, low: int, high: int, was: list[int] | None,
                     deltas) -> bool:
        """Merge a source's rows of ``low <= id < high`` that aren't merged yet.

        The rows are written once, and their totals, ids and figures read from that copy, so a
        source that grows meanwhile can't make them differ. ``deltas`` maps rows to totals.
        """
        rows = rows.where((F.col("id") >= low) & (F.col("id") < high))
        if was is not None:
            ids = self.table(f"{kind}_ids")
            if ids is not None:
                rows = rows.join(ids.where((F.col("id") >= low) & (F.col("id") < high)), "id", "left_anti")
        stage = f"_stage/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{stage}")
        try:
            staged = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{stage}")
            n, x = staged.agg(*figures()).first()
            if not n:
                return False
            totals = {**deltas(staged), f"{kind}_ids": staged.select("id")}
            return self.apply(f"{kind}-{low}-{high}-{n}-{x}", totals, (kind, [low, high, n, x], was))
        finally:
            self.files.delete(stage)

    # ---- upkeep ----
    def _tier(self, size: int) -> int:
        return int(math.log(max(size / self.tier_bytes, 1), self.fanout))

    def _due(self, state: State) -> tuple[str, dict[str, dict]] | None:
        """A table and those of its runs that share a size tier, if there are ``fanout`` or more."""
        for name, runs in sorted(state.runs.items()):
            tiers: dict[int, dict[str, dict]] = {}
            for run, f in runs.items():
                tiers.setdefault(self._tier(f["bytes"]), {})[run] = f
            for _, group in sorted(tiers.items()):
                if len(group) >= self.fanout:
                    return name, group
        return None

    def compact(self) -> int:
        """Replace runs of one size tier by their sum until no tier is full; returns how often."""
        done = 0
        while due := self._due(self.log.state()):
            name, group = due
            spec = RUN_SPECS[name]
            columns = [*spec.columns, *(["_seq"] if spec.first else [])]
            added = self._write_run(name, add_up(self._rows(name, group), spec, keep_seq=True), columns,
                                    next(iter(group.values()))["schema"])
            entry = {"add": [added], "drop": [[name, run] for run in group]}
            while True:
                state = self.log.state()
                if not group.keys() <= state.runs[name].keys():
                    self._discard([added])
                    break
                if self.log.commit(state, entry):
                    done += 1
                    break
        return done

    def vacuum(self, keep_seconds: float = KEEP_SECONDS) -> list[str]:
        """Delete folders that no state of the last ``keep_seconds`` names; returns them."""
        before, gone = time.time() - keep_seconds, []
        folders = [(f"{table}/{name}", written) for table in RUN_SPECS
                   for name, written in self.files.list(table)]
        folders += [(f"_stage/{name}", written) for name, written in self.files.list("_stage")]
        state = self.log.state()                     # read after the listing: a run committed since is live
        live = {f"{table}/run={run}" for table, runs in state.runs.items() for run in runs}
        for folder, written in folders:
            if folder not in live and state.retired.get(folder, written) < before:
                self.files.delete(folder)
                gone.append(folder)
        forgotten = [f for f in state.retired if f in gone or not self.files.exists(f)]
        if forgotten:
            while not self.log.commit(state, {"forget": forgotten}):
                state = self.log.state()
        self.log.trim(before)
        return gone
