"""Batch jobs: the one-shot build, the incremental id-batch loop, the page.

``run_build`` is the Spark form of the reference's aggregation jobs: it
writes the cleaned posts once beside its tables (the output root is shared by
definition), which cuts the lineage -- a lost executor re-reads that table instead of
re-running the source scan and joins -- then builds the totals from it and
the graph tables from the written totals, one write job per table.

``run_incremental`` keeps the reference's id-window loop for loads that
arrive over time: half-open windows (D1), each merged once (D19). Over a
``RunStore`` the windows hold about as many rows each, late ids are merged
too, and several jobs may run at once.

``run_graph`` writes the four graph tables from the totals that a store has
accumulated, as the original's export did from its database.

``serve_compare`` answers the comparison page from the written tables, so
the page's filters reach the Parquet scans (and the ``year`` partitions);
``serve_compare_store`` does so from a store and the graph written from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import tags as t
from ..operators import totals as tot
from ..operators.skew import heavy_keys
from ..sinks import bucketed
from ..sinks.writers import CLUSTER, write_table, write_tables
from ..sources import batches as b
from ..sources.fixtures import Sources
from ..streaming.coverage import Conflict, plan
from ..streaming.incremental import (TotalsStore, apply_comment_batch, apply_post_batch,
                                     comment_batch_deltas, post_batch_deltas)
from ..streaming.run_store import RunStore
from .tables import TagTables, compare


POST_COMMENTS = "post_comments"
BASE_TABLES = ("tech_rel", "tech_node", "tag_date", "tag_list", "user_tech")
POST_DERIVED = ("graph_vertices", "graph_edges", "tag_rollup")
DERIVED_TABLES = (*POST_DERIVED, "user_vertices", "contribute_edges")


def run_build(spark: SparkSession, sources: Sources, out_root: str,
              stage_root: str | None = None, buckets: int = 0) -> dict[str, str]:
    """Write all stored tables under ``out_root``; returns their paths.

    Three steps, each reading what the previous one wrote: the cleaned
    posts; the five totals (one aggregation each; comments of hot posts are
    dealt out by a sketch of their post ids); the graph tables, derived
    from the written totals so the pair and comment aggregations run once.

    With ``buckets`` the posts and comments are also kept in so many buckets of the
    post id (``<out>/post_comments``); ``run_user_tech`` then joins them without a shuffle.
    """
    stage = stage_root or f"{out_root.rstrip('/')}/_stage-{uuid.uuid4().hex[:12]}"
    write_table(t.post_tags(sources.posts), f"{stage}/post_tags")
    given = {"post_tags": spark.read.parquet(f"{stage}/post_tags")}
    if buckets:
        kept = f"{out_root.rstrip('/')}/{POST_COMMENTS}"
        bucketed.write_post_comments(given["post_tags"], sources.comments, kept, buckets)
        given["user_tech"] = bucketed.user_tech(spark, kept, sources.users)
    else:
        given["user_tech"] = tot.user_tech(given["post_tags"], sources.comments, sources.users,
                                           heavy_keys(sources.comments, "post_id"))
    base = TagTables(sources, given=given)
    paths = write_tables({name: getattr(base, name) for name in BASE_TABLES}, out_root)
    given.update({name: spark.read.parquet(path) for name, path in paths.items()})
    derived = TagTables(sources, given=given)
    paths.update(write_tables({name: getattr(derived, name) for name in DERIVED_TABLES},
                              out_root))
    if stage_root is None:
        delete_path(spark, stage)
    return paths


def run_user_tech(spark: SparkSession, out_root: str, users: DataFrame, to: str) -> str:
    """USER_TECH under ``to``, of the users as they are now and the posts and comments that a build
    with ``buckets`` kept. Written beside the table in use, which a reader may hold open."""
    kept = f"{out_root.rstrip('/')}/{POST_COMMENTS}"
    write_table(bucketed.user_tech(spark, kept, users), to, cluster_by=CLUSTER["user_tech"])
    return to


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this job wrote, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _windows(store: TotalsStore, ids: DataFrame, kind: str, size: int) -> list[tuple[int, int]]:
    """The next half-open id windows of a table: from the end of the last window
    merged (the store's cursor; the smallest id at first) to the largest id,
    the last window clipped to what is there. Ids arrive in growing order."""
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return []
    done = store.cursor(kind)
    start = low if done is None else done
    return [(a, min(b_, high + 1)) for a, b_ in b.batch_bounds(start, high, size)]


def merge_source(store: RunStore, kind: str, rows: DataFrame, per_batch: int, deltas) -> int:
    """Merge what a source holds beyond the store's intervals, ``per_batch`` rows or so at a time,
    compacting after each batch. If another writer took ids of a window, the rest is planned again.
    Returns batches applied."""
    applied = 0
    while True:
        try:
            for low, high, was in plan(rows.select("id"), store.covered(kind), per_batch):
                applied += store.merge_window(kind, rows, low, high, was, deltas)
                store.compact()
            return applied
        except Conflict:
            continue


def run_incremental(spark: SparkSession, sources: Sources, store: TotalsStore | RunStore,
                    posts_per_batch: int = b.POSTS_PER_BATCH,
                    comments_per_batch: int = b.COMMENTS_PER_BATCH) -> int:
    """The reference's loops over Posts and Comments ids. Every window is a
    pushed-down range scan named by its true bounds in the ledger; a later run
    goes on where the last one ended, whatever its batch size, so no id is
    lost or added twice. Returns batches applied."""
    if isinstance(store, RunStore):
        return (merge_source(store, "posts", sources.posts, posts_per_batch, post_batch_deltas)
                + merge_source(store, "comments", sources.comments, comments_per_batch,
                               lambda rows: comment_batch_deltas(rows, sources.posts, sources.users)))
    applied = 0
    for low, high in _windows(store, sources.posts, "posts", posts_per_batch):
        applied += apply_post_batch(store, b.id_batch(sources.posts, low, high),
                                    f"posts-{low}-{high}")
    for low, high in _windows(store, sources.comments, "comments", comments_per_batch):
        applied += apply_comment_batch(store, b.id_batch(sources.comments, low, high),
                                       sources.posts, sources.users, f"comments-{low}-{high}")
    return applied


def _store_tables(store: TotalsStore | RunStore) -> dict[str, DataFrame]:
    """The current totals of a store by name; those never written are left out."""
    found = {name: store.table(name) for name in BASE_TABLES}
    return {name: df for name, df in found.items() if df is not None}


def run_graph(store: TotalsStore | RunStore, out_root: str) -> dict[str, str]:
    """The graph tables of the totals accumulated in ``store``; returns their
    paths. A store without comments gives vertices, edges and rollups only."""
    totals = _store_tables(store)
    if "tech_node" not in totals:
        raise ValueError("the store holds no batch of posts yet")
    tables = TagTables(None, given=totals)
    names = DERIVED_TABLES if "user_tech" in totals else POST_DERIVED
    return write_tables({name: getattr(tables, name) for name in names}, out_root)


def serve_compare_store(store: TotalsStore | RunStore, graph_root: str, tech: str, tech_with: str,
                        tech_or: str) -> dict[str, DataFrame]:
    """The page's sections over a store's totals and the graph ``run_graph`` wrote."""
    edges = store.spark.read.parquet(f"{graph_root.rstrip('/')}/graph_edges")
    given = {**_store_tables(store), "graph_edges": edges}
    missing = [name for name in BASE_TABLES if name not in given]
    if missing:
        raise ValueError(f"the store holds no {', '.join(missing)} yet")
    return compare(TagTables(None, given=given), tech, tech_with, tech_or)


def serve_compare(spark: SparkSession, root: str, tech: str, tech_with: str,
                  tech_or: str) -> dict[str, DataFrame]:
    """The page's sections over the written tables. Folders written before there were
    rollups have none; the trend then sums days."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in TagTables.STORED}
    if not path_exists(spark, paths["tag_rollup"]):
        del paths["tag_rollup"]
    given = {name: spark.read.parquet(path) for name, path in paths.items()}
    return compare(TagTables(None, given=given), tech, tech_with, tech_or)
