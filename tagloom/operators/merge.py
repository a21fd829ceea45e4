"""Merging a batch's totals into stored totals.

A9 -- additive upsert: a key absent from the store is inserted, a present key
gets its sums increased: one ``union`` plus one ``groupBy`` on the key (a single
shuffle, with partial aggregation), instead of the reference's
insert-zero-then-update SQL pair. A10 -- insert if absent, first write wins: the
store plus the rows of the batch whose key it lacks (an anti join; the stored
rows themselves are neither sorted nor aggregated).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class TotalsSpec:
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    first: tuple[str, ...] = ()   # columns where the stored value wins ...
    entity: tuple[str, ...] = ()  # ... as one value for each entity, the keys if empty
    partition_by: tuple[str, ...] = ()
    order: tuple[str, ...] = ()   # column order of the table, when not keys-first-sums

    @property
    def columns(self) -> list[str]:
        return list(self.order) if self.order else [*self.keys, *self.first, *self.sums]


# The stored result tables (FIXTURES.md section 2) and how they merge.
SPECS = {
    "tech_rel": TotalsSpec(("technode1", "technode2"), ("weight", "cnt")),
    "tech_node": TotalsSpec(("technode",), ("weight", "cnt")),
    "tag_date": TotalsSpec(("year", "day", "tech"), ("app_num",), partition_by=("year",)),
    "tag_list": TotalsSpec(("year", "day", "techlist"), ("weight", "app_num"),
                           partition_by=("year",)),
    "user_tech": TotalsSpec(("user_id", "tech"), ("score", "cnt"),
                            first=("user_name", "user_website"), entity=("user_id",),
                            order=("user_id", "user_name", "user_website", "tech", "score",
                                   "cnt")),
}


def merge_totals(old: DataFrame, delta: DataFrame, spec: TotalsSpec) -> DataFrame:
    """``old`` plus ``delta`` per key; ``first`` columns keep the stored
    value (the delta's only for a new entity).

    The first values are one row per entity (K5: one node per user, whose first
    name stays, on tags of later batches too), joined after the sums, so that the
    sums need no text in their aggregate. Of several values in one batch the least counts.
    """
    tagged = (old.select(*spec.columns, F.lit(0).alias("_src"))
              .unionByName(delta.select(*spec.columns, F.lit(1).alias("_src"))))
    sums = tagged.groupBy(*spec.keys).agg(*(F.sum(c).cast("bigint").alias(c) for c in spec.sums))
    if not spec.first:
        return sums.select(*spec.columns)
    entity = list(spec.entity or spec.keys)
    firsts = (tagged.groupBy(*entity).agg(F.min(F.struct("_src", *spec.first)).alias("_first"))
              .select(*entity, *(F.col(f"_first.{c}").alias(c) for c in spec.first)))
    return sums.join(firsts, entity).select(*spec.columns)


def insert_if_absent(old: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """A10: rows of ``delta`` whose key is not stored yet are added; stored
    rows are never changed."""
    fresh = delta.join(old.select(*keys), keys, "left_anti")
    columns = [*keys, *(c for c in old.columns if c not in keys)]
    return old.select(*columns).unionByName(fresh.select(*columns))


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """S6 + U1: consecutive batches as one frame (union all)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
