"""Connected components of an edge table by alternating large-star and small-star.

A table of at most ``ONE_TASK`` edges, which a single task holds in a few MB, is
joined up there at once; only larger tables go through the rounds of shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, arrow_map

#: Edges that one task joins up by itself.
ONE_TASK = 1 << 17


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest node reachable from each node of all the edges (u, v) of the task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        up = parent.setdefault(x, x)
        while up != x:
            parent[x] = x = parent[up]
            up = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "component"]
        )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with v < u.

    Large-star links every larger neighbour of a node to the smallest node of
    its neighbourhood; small-star does so for the smaller neighbours and the
    node itself. The smallest neighbour is a partial aggregate, so a hub with
    any number of neighbours is never gathered in one place.
    """
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select("u", "v")
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = around.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node's own link to its smaller neighbours is kept by those neighbours' stars
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u > v").distinct()


def components(edges: DataFrame, staged: Staged, name: str = "cc", most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with an edge.

    ``edges`` has columns a, b of numbers; direction, repeats and loops don't
    matter, rows with a null are ignored. Each round is a written table; the
    driver sees one row with the count and checksum that tell whether a round
    changed anything.
    """
    last = staged.write(
        edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")),
        f"{name}-0",
    )
    if last.count() <= ONE_TASK:
        return last.coalesce(1).transform(arrow_map, _joined, "node long, component long")
    mark = None
    for k in range(1, most_rounds + 1):
        now = staged.write(_star(_star(last, large=True), large=False), f"{name}-{k}")
        staged.drop(f"{name}-{k - 1}")
        last = now
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = last.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return last.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
