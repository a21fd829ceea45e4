"""Incremental totals: id batches merged into stored tables exactly once.

The reference loops over id windows and adds each window's totals into
database tables (insert zero rows, then update), so a replayed window is
added twice (D19). Here:

* every stored table lives under ``<root>/<table>/v=<n>``; a merge reads
  the current version and writes version n+1 to a new directory, so a path
  is never overwritten while it is read, and the lineage of a version is one
  scan. Year-split tables keep a version per year and a merge rewrites only
  the years in its batch;
* ``<root>/_ledger`` is an append-only Parquet table of
  ``(batch_id, table, part, version)``. A version exists only once its ledger
  rows are committed (one append job after all table writes), so a crash
  leaves at most an unreferenced directory that the next attempt overwrites;
* a batch id already in the ledger is skipped, which makes a replay -- by a
  restarted job or by Structured Streaming re-running an epoch -- a no-op.

``post_batch_deltas`` / ``comment_batch_deltas`` compute one batch's totals
with the same operators as the one-shot build. ``stream_posts`` drives the
store from a file stream with ``foreachBatch``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import tags as t
from ..operators import totals as tot
from ..operators.merge import SPECS, merge_totals
from ..operators.skew import heavy_of, heavy_sketch
from ..sinks.writers import CLUSTER, write_jdbc, write_table
from ..sources.jdbc import read_jdbc, read_jdbc_partitioned
from ..sources.fixtures import SCHEMAS

LEDGER_SCHEMA = "batch_id string, table string, part int, version int"
WHOLE = -1                  # the part of a table that is not split by year
BATCH_MARK = "_batch"       # one ledger row per applied batch, even an empty one
JDBC_LEDGER_SCHEMA = "batch_id string, tbl string, part int, version int"
#: Tables of a database that grow with the data and are read whole: split by this id.
JDBC_SPLIT = {"user_tech": "user_id"}
JDBC_LEDGER_TYPES = "batch_id VARCHAR(256), tbl VARCHAR(64)"


def post_batch_deltas(posts_batch: DataFrame) -> dict[str, DataFrame]:
    """The four post totals of one batch of posts (the reference's
    per-window work: list, pair, node and date totals)."""
    pt = t.post_tags(posts_batch)
    return {"tech_rel": tot.tech_rel(pt), "tech_node": tot.tech_node(pt),
            "tag_date": tot.tag_date(pt), "tag_list": tot.tag_list(pt)}


def comment_batch_deltas(comments_batch: DataFrame, posts: DataFrame,
                         users: DataFrame) -> dict[str, DataFrame]:
    """USER_TECH totals of one batch of comments.

    S8: the batch only needs the posts it comments on. A one-row probe gives
    the range of its post ids; as literals they become a pushed-down range
    filter on the posts scan (row groups outside it are skipped when posts
    are stored in id order), and the join keeps exactly the matching posts.
    The same probe names the posts that hold a large share of the batch.
    """
    lo, hi, sketch = comments_batch.agg(F.min("post_id"), F.max("post_id"), heavy_sketch("post_id")).first()
    if lo is not None:
        posts = posts.where(F.col("id").between(lo, hi))
    return {"user_tech": tot.user_tech(t.post_tags(posts), comments_batch, users, heavy_of(sketch))}


class TotalsStore:
    """Versioned totals tables under one shared folder.

    A table split by year (``tag_date``, ``tag_list``) is versioned per year:
    a batch rewrites only the years its delta touches (new posts mostly touch
    the latest one), so the cost of a merge follows the touched years, not
    the whole history. Other tables are rewritten whole; they are bounded by
    the tag vocabulary (``tech_rel``, ``tech_node``) or by users x tags.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- ledger ----
    @property
    def ledger_path(self) -> str:
        return f"{self.root}/_ledger"

    def ledger(self) -> DataFrame:
        """The ledger; empty only where its folder is missing. Any other failure to
        read it is an error, never an empty store."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.ledger_path)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)

    def _append_ledger(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(self.ledger_path)

    def versions(self) -> dict[tuple[str, int], int]:
        """Latest version of every (table, part); part is the year, or WHOLE.
        A few rows per table: one per year at most."""
        rows = (self.ledger().where(F.col("table") != BATCH_MARK)
                .groupBy("table", "part").agg(F.max("version").alias("v")).collect())
        return {(r["table"], r["part"]): r["v"] for r in rows}

    def applied(self, batch_id: str) -> bool:
        return self.ledger().where(F.col("batch_id") == batch_id).limit(1).count() > 0

    def cursor(self, kind: str) -> int | None:
        """The end of the last id window ``kind-<low>-<high>`` merged; None before the first."""
        end = F.regexp_extract("batch_id", f"^{kind}-[0-9]+-([0-9]+)$", 1)
        row = (self.ledger().where(F.col("table") == BATCH_MARK).where(end != "")
               .agg(F.max(end.cast("bigint")).alias("end")).first())
        return row["end"]

    # ---- tables ----
    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version}"

    def _read_part(self, name: str, part: int, version: int) -> DataFrame:
        base = self.path(name, version)
        if part == WHOLE:
            return self.spark.read.parquet(base)
        return (self.spark.read.option("basePath", base)
                .parquet(f"{base}/{SPECS[name].partition_by[0]}={part}"))

    def _write_version(self, df: DataFrame, name: str, version: int) -> None:
        spec = SPECS[name]
        write_table(df, self.path(name, version), "overwrite", spec.partition_by,
                    CLUSTER.get(name, ()))

    def _read(self, name: str, parts: dict[int, int]) -> DataFrame | None:
        """The union of the given parts at their versions."""
        spec = SPECS[name]
        frames = [self._read_part(name, part, v) for part, v in sorted(parts.items())]
        if not frames:
            return None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out.select(*spec.columns)

    def table(self, name: str, years: list[int] | None = None) -> DataFrame | None:
        """The current table (only the given years of a year-split one)."""
        parts = {p: v for (t, p), v in self.versions().items()
                 if t == name and (years is None or p == WHOLE or p in years)}
        return self._read(name, parts)

    def _merge_one(self, batch_id: str, name: str, delta: DataFrame,
                   have: dict[int, int]) -> list[tuple]:
        """Write the next version of one table; returns its ledger rows."""
        spec = SPECS[name]
        nv = max(have.values(), default=-1) + 1
        if not spec.partition_by:
            old = self._read(name, have)
            merged = delta.select(*spec.columns) if old is None else merge_totals(old, delta, spec)
            self._write_version(merged, name, nv)
            return [(batch_id, name, WHOLE, nv)]
        # the batch's delta is used twice (its years, then the write): kept
        # for this merge only; a lost block is recomputed from the batch
        delta = delta.persist()
        try:
            touched = sorted(r[0] for r in delta.select(spec.partition_by[0]).distinct().collect())
            if not touched:
                return []
            old = self._read(name, {p: have[p] for p in touched if p in have})
            merged = delta.select(*spec.columns) if old is None else merge_totals(old, delta, spec)
            self._write_version(merged, name, nv)
            return [(batch_id, name, p, nv) for p in touched]
        finally:
            delta.unpersist()

    def apply(self, batch_id: str, deltas: dict[str, DataFrame]) -> bool:
        """A9 + D19: merge the batch's totals into the stored ones once.
        Returns False when the batch was applied before."""
        if self.applied(batch_id):
            return False
        current = self.versions()
        written = [(batch_id, BATCH_MARK, WHOLE, -1)]
        for name, delta in deltas.items():
            have = {p: v for (t, p), v in current.items() if t == name}
            written += self._merge_one(batch_id, name, delta, have)
        # the commit: one append of the ledger rows
        self._append_ledger(self.spark.createDataFrame(written, LEDGER_SCHEMA))
        return True


class JdbcTotalsStore(TotalsStore):
    """The same store in a database (the original kept its totals there).

    Version n of a table is the table ``<PREFIX>_<NAME>_V<n>``; the ledger is
    the table ``<PREFIX>_LEDGER``, appended in one single-partition write,
    which is one transaction. The ledger table is created up front (an
    ``ignore`` write), so a failed ledger read is an error, never an empty
    store. A year part is read with ``year = p`` pushed into the database.
    """

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                 prefix: str = "TAGLOOM", quote: str = '"'):
        self.spark = spark
        self.url = url
        self.quote = quote
        self.props = dict(properties or {})
        self.prefix = prefix.upper()
        empty = spark.createDataFrame([], JDBC_LEDGER_SCHEMA)
        write_jdbc(empty, url, self.ledger_table, mode="ignore",
                   properties={**self.props, "createTableColumnTypes": JDBC_LEDGER_TYPES})

    @property
    def ledger_table(self) -> str:
        return f"{self.prefix}_LEDGER"

    def table_name(self, name: str, version: int) -> str:
        return f"{self.prefix}_{name.upper()}_V{version}"

    def ledger(self) -> DataFrame:
        return (read_jdbc(self.spark, self.url, table=self.ledger_table, properties=self.props)
                .select("batch_id", F.col("tbl").alias("table"), "part", "version"))

    def _append_ledger(self, rows: DataFrame) -> None:
        write_jdbc(rows.withColumnRenamed("table", "tbl").coalesce(1), self.url,
                   self.ledger_table, mode="append", properties=self.props)

    def _read_part(self, name: str, part: int, version: int) -> DataFrame:
        table = self.table_name(name, version)
        if name in JDBC_SPLIT:
            return read_jdbc_partitioned(self.spark, self.url, table,
                                         f'{self.quote}{JDBC_SPLIT[name]}{self.quote}',
                                         properties=self.props)
        df = read_jdbc(self.spark, self.url, table=table, properties=self.props)
        if part == WHOLE:
            return df
        return df.where(F.col(SPECS[name].partition_by[0]) == part)

    def _write_version(self, df: DataFrame, name: str, version: int) -> None:
        write_jdbc(df, self.url, self.table_name(name, version), mode="overwrite",
                   properties=self.props)


def apply_post_batch(store: TotalsStore, posts_batch: DataFrame, batch_id: str) -> bool:
    return store.apply(batch_id, post_batch_deltas(posts_batch))


def apply_comment_batch(store: TotalsStore, comments_batch: DataFrame, posts: DataFrame,
                        users: DataFrame, batch_id: str) -> bool:
    return store.apply(batch_id, comment_batch_deltas(comments_batch, posts, users))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same after a restart, new with a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def stream_posts(spark: SparkSession, source_dir: str, store: TotalsStore,
                 checkpoint: str, files_per_batch: int = 1, prefix: str = "posts"):
    """Structured Streaming over a folder of post files: each micro-batch is
    merged into the store through ``foreachBatch``; the stream's own id and the
    epoch name the batch, so an epoch re-run after a restart is skipped by the
    ledger and another stream into the same store is not.
    Runs what is available and stops (``availableNow``)."""
    stream = (spark.readStream.schema(SCHEMAS["posts"])
              .option("maxFilesPerTrigger", files_per_batch).parquet(source_dir))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            apply_post_batch(store, batch, f"{prefix}-{stream_id(spark, checkpoint)}-{epoch_id}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_comments(spark: SparkSession, source_dir: str, store: TotalsStore,
                    posts: DataFrame, users: DataFrame, checkpoint: str,
                    files_per_batch: int = 1, prefix: str = "comments"):
    """The user job as a stream: each micro-batch of comment files is joined
    to the posts and users tables (a stream-static join inside the batch) and
    merged into USER_TECH once."""
    stream = (spark.readStream.schema(SCHEMAS["comments"])
              .option("maxFilesPerTrigger", files_per_batch).parquet(source_dir))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()          # read twice: the post-id probe, then the merge
        try:
            apply_comment_batch(store, batch, posts, users,
                                f"{prefix}-{stream_id(spark, checkpoint)}-{epoch_id}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def merge_batch(store: TotalsStore, deltas: dict[str, DataFrame], batch_id: str) -> bool:
    """The entry point ``merge_batch(tables, delta, batch_id)``: merge one
    batch's totals into the store once (see ``TotalsStore.apply``)."""
    return store.apply(batch_id, deltas)
