"""Which ids of a source are merged: intervals with counts, and windows by rows.

An interval ``[low, high, n, x]`` says that ``n`` ids of ``low <= id < high`` are merged
and that their hashes' exclusive or is ``x``. One scan of the source's ids counts each
interval again: one whose figures differ holds late ids, and ids between the intervals
are new. At most ``MAX_INTERVALS`` are kept; beyond that the two neighbours with the
fewest ids become one, with whatever lies between them, which the next count then finds.
So the scan compares an id with a bounded number of edges, and no id is lost at any number.

New ids are cut into windows of about ``rows`` rows at quantiles of the ids, so sparse or
uneven ids don't make empty or crowded windows. Rows without an id stand in no window. Ids
are taken as unique; rows that leave the source stay counted.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

MAX_INTERVALS = 64
PARTS = 1000             # windows that one quantile sketch gives; larger tables are cut again inside them


class Conflict(Exception):
    """Another writer merged ids of the window that was about to be committed."""


def add_interval(intervals: list[list[int]], new: list[int]) -> list[list[int]]:
    """The intervals after a commit: the counts of an interval that is there grow."""
    low, high, n, x = new
    out = {(a, b): [a, b, m, y] for a, b, m, y in intervals}
    _, _, m, y = out.get((low, high), [low, high, 0, 0])
    out[low, high] = [low, high, m + n, y ^ x]
    kept = sorted(out.values())
    while len(kept) > MAX_INTERVALS:
        k = min(range(len(kept) - 1), key=lambda i: kept[i][2] + kept[i + 1][2])
        (a, _, m, y), (_, b, n, x) = kept[k], kept[k + 1]
        kept[k:k + 2] = [[a, b, m + n, y ^ x]]
    return kept


def fits(intervals: list[list[int]], low: int, high: int, was: list[int] | None) -> bool:
    """Whether a window may still be merged: a new one touches no interval, a late one's is unchanged."""
    if was is not None:
        return was in intervals
    return all(high <= a or b <= low for a, b, _, _ in intervals)


def figures(column: str = "id") -> list[Column]:
    """Count and combined hash of ids."""
    return [F.count(column).alias("n"),
            F.coalesce(F.expr(f"bit_xor(xxhash64({column}))"), F.lit(0)).alias("x")]


def windows(ids: DataFrame, low: int, high: int, n: int, rows: int) -> Iterator[tuple[int, int]]:
    """Half-open windows that cover ``[low, high)``, of about ``rows`` of its ``n`` ids each."""
    parts = min(PARTS, -(-n // rows))
    if parts <= 1 or high - low <= 1:
        yield low, high
        return
    inside = ids.where((F.col("id") >= low) & (F.col("id") < high))
    cuts = inside.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)], 20 * PARTS)).first()[0]
    edges = sorted({low, high, *(c for c in cuts or () if low < c < high)})
    for a, b in zip(edges, edges[1:]):
        if n > 2 * parts * rows and len(edges) > 2:
            yield from windows(ids, a, b, n // parts, rows)
        else:
            yield a, b


def plan(ids: DataFrame, intervals: list[list[int]], rows: int
         ) -> Iterator[tuple[int, int, list[int] | None]]:
    """What is to be merged, as ``(low, high, was)``: intervals that changed (``was`` is the
    interval), then windows of new ids (``was`` is None). One aggregation of the ids, and one
    sketch for each stretch of new ids that has more than ``rows``."""
    edges = sorted({e for a, b, _, _ in intervals for e in (a, b)})
    region = sum((F.when(F.col("id") >= F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    found = (ids.where("id is not null").groupBy(region.alias("region"))
             .agg(*figures(), F.min("id").alias("low"), F.max("id").alias("high")).collect())
    start = {a: [a, b, n, x] for a, b, n, x in intervals}
    late, new = [], []
    for row in sorted(found, key=lambda r: r["region"]):
        was = start.get(edges[row["region"] - 1]) if row["region"] else None
        if was is None:
            new.append(row)
        elif was[2:] != [row["n"], row["x"]]:
            late.append(was)
    for was in late:
        yield was[0], was[1], was
    for row in new:
        for low, high in windows(ids, row["low"], row["high"] + 1, row["n"], rows):
            yield low, high, None
