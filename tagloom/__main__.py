"""Job entry points for ``spark-submit`` (or ``python -m tagloom``).

  build        write every stored table from Posts / Comments / Users
  incremental  merge id batches of those into a versioned totals store
  graph        write the graph tables from a store's totals
  page         print the comparison page of three tags, from written tables or a store

Posts, Comments and Users are files, or tables of the database that
``--source-url`` names, with the original column names (``sources.qa``); the
session comes from ``spark-submit`` (its master, its ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.jobs import (run_build, run_graph, run_incremental, serve_compare,
                         serve_compare_store)
from .session import apply_scale_conf
from .sources.fixtures import Sources
from .sources.qa import read_sources, read_sources_jdbc
from .streaming.incremental import JdbcTotalsStore, TotalsStore
from .streaming.run_store import RunStore


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "incremental"):
        s = sub.add_parser(name)
        s.add_argument("--posts", required=True)
        s.add_argument("--comments", required=True)
        s.add_argument("--users", required=True)
        s.add_argument("--format", default="parquet")
        s.add_argument("--source-url", default=None,
                       help="read --posts, --comments, --users as tables of this database")
        s.add_argument("--source-driver", default=None)
        s.add_argument("--out", required=(name == "build"),
                       help="output folder (shared file system)")
    sub.choices["build"].add_argument("--buckets", type=int, default=0,
                                      help="also keep posts and comments in so many buckets of the post id")
    inc = sub.choices["incremental"]
    inc.add_argument("--jdbc-url", default=None,
                     help="keep the totals in this database instead of --out")
    inc.add_argument("--jdbc-driver", default=None)
    inc.add_argument("--runs", action="store_true",
                     help="keep the totals in --out as runs: batches by rows, late ids, several jobs at once")
    inc.add_argument("--posts-per-batch", type=int, default=None)
    inc.add_argument("--comments-per-batch", type=int, default=None)
    page = sub.add_parser("page")
    page.add_argument("--tables", help="folder written by build (or graph, with a store)",
                      required=True)
    graph = sub.add_parser("graph")
    graph.add_argument("--out", required=True, help="folder of the graph tables")
    for s in (graph, page):
        s.add_argument("--store", default=None, help="folder written by incremental")
        s.add_argument("--jdbc-url", default=None, help="database written by incremental")
        s.add_argument("--jdbc-driver", default=None)
    page.add_argument("tech")
    page.add_argument("tech_with")
    page.add_argument("tech_or")
    return p


def _properties(driver: str | None) -> dict[str, str]:
    return {"driver": driver} if driver else {}


def _sources(spark: SparkSession, args: argparse.Namespace) -> Sources:
    where = {"posts": args.posts, "comments": args.comments, "users": args.users}
    if args.source_url:
        return read_sources_jdbc(spark, args.source_url, where, _properties(args.source_driver))
    return read_sources(spark, where, args.format)


def _store(spark: SparkSession, args: argparse.Namespace,
           folder: str | None) -> TotalsStore | RunStore | None:
    """The store asked for: runs where ``--runs`` says so or the folder holds some."""
    if args.jdbc_url:
        return JdbcTotalsStore(spark, args.jdbc_url, _properties(args.jdbc_driver))
    if not folder:
        return None
    runs = RunStore(spark, folder)
    if getattr(args, "runs", False):
        if runs.files.exists("_ledger"):
            raise SystemExit(f"{folder} holds whole tables by batch, not runs")
        return runs
    return runs if runs.files.exists("_log") else TotalsStore(spark, folder)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = apply_scale_conf(spark or SparkSession.builder.appName("tagloom").getOrCreate())
    if args.command in ("build", "incremental"):
        sources = _sources(spark, args)
        if args.command == "build":
            for name, path in sorted(run_build(spark, sources, args.out, buckets=args.buckets).items()):
                print(f"{name}\t{path}")
        else:
            kw = {k: v for k, v in (("posts_per_batch", args.posts_per_batch),
                                    ("comments_per_batch", args.comments_per_batch)) if v}
            store = _store(spark, args, args.out)
            if store is None:
                raise SystemExit("incremental needs --out or --jdbc-url")
            n = run_incremental(spark, sources, store, **kw)
            print(f"batches applied\t{n}")
            if isinstance(store, RunStore):
                store.vacuum()
    elif args.command == "graph":
        store = _store(spark, args, args.store)
        if store is None:
            raise SystemExit("graph needs --store or --jdbc-url")
        for name, path in sorted(run_graph(store, args.out).items()):
            print(f"{name}\t{path}")
    else:
        store, asked = _store(spark, args, args.store), (args.tech, args.tech_with, args.tech_or)
        page = (serve_compare(spark, args.tables, *asked) if store is None
                else serve_compare_store(store, args.tables, *asked))
        for name, df in page.items():
            print(f"== {name}")
            # whole sections: months and contributors, bounded by the page itself
            df.show(df.count(), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
