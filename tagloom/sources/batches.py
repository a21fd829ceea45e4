"""Probes, id-range batches and paging (S3..S7).

The reference loops over id windows to bound memory and unites three windows
per loop. On Spark the whole table is one scan (the engine spills); id
batches matter only for incremental loads, where a batch is a half-open range
``[low, high)`` so no boundary id is lost (D1). A range filter on ``id``
reaches the Parquet scan (row-group skipping) or the JDBC query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values of the reference's loops (ids per batch, batches per loop).
POSTS_PER_BATCH = 100_000
COMMENTS_PER_BATCH = 200_000
BATCHES_PER_LOOP = 3
EXPORT_PAGE_ROWS = 300_000


def max_id(df: DataFrame, column: str = "id") -> DataFrame:
    """S3: one-row probe (answered from Parquet footers when possible)."""
    return df.agg(F.max(column).alias("max_id"))


def row_count(df: DataFrame) -> DataFrame:
    """S4."""
    return df.agg(F.count(F.lit(1)).alias("count_num"))


def id_batch(df: DataFrame, low: int, high: int, column: str = "id") -> DataFrame:
    """Rows with ``low <= id < high``."""
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def batch_bounds(start: int, stop: int, size: int) -> list[tuple[int, int]]:
    """Half-open windows covering ``[start, stop]`` (stop included, D1)."""
    out, low = [], start
    while low <= stop:
        out.append((low, low + size))
        low += size
    return out


def with_batch(df: DataFrame, size: int, per_loop: int = BATCHES_PER_LOOP,
               column: str = "id") -> DataFrame:
    """Label every row with its batch ``[low, high)``, its loop (``per_loop``
    consecutive batches) and its slot within the loop -- the batch plan of
    the whole table in one projection."""
    b = F.floor(F.col(column) / F.lit(size)).cast("bigint")
    return df.select("*", b.alias("batch"),
                     (b * size).alias("batch_low"), ((b + 1) * size).alias("batch_high"),
                     F.floor(b / F.lit(per_loop)).cast("bigint").alias("loop"),
                     F.pmod(b, F.lit(per_loop)).cast("int").alias("slot"))


def batch_counts(df: DataFrame, size: int, weight: str = "weight",
                 column: str = "id") -> DataFrame:
    """Rows and weight per id batch."""
    return (df.groupBy(F.floor(F.col(column) / F.lit(size)).cast("bigint").alias("batch"))
            .agg(F.count(F.lit(1)).alias("posts"),
                 F.sum(weight).cast("bigint").alias("weight")))


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """S7 with a fixed order (the reference pages without ORDER BY): rows
    ``offset .. offset+limit-1``. Planned as a per-task top-(offset+limit)
    and a merge, so only offset+limit rows per task move."""
    return df.orderBy(*order).offset(offset).limit(limit)


def semi_by_keys(df: DataFrame, df_key: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``. The key side is
    deduplicated first (partial aggregate before its shuffle), so a key that
    occurs in a third of the rows still ships once per task."""
    k = keys.select(F.col(key).alias("_k")).distinct()
    return df.join(k, df[df_key] == k["_k"], "left_semi")
