"""Paging by rank over a stored order.

``ORDER BY ... OFFSET`` sorts the whole table for every page, and one task merges offset + limit
rows. Here a table is written once in its order: range-partitioned, sorted within each file, the
files disjoint in their keys. An index beside it holds one row a file, its number of rows
and the rank of its first row. A page then reads the files that its ranks fall in, a late page
no more than the first one, and pages can be followed to the end.

Results: nulls sort first; rows that tie in the whole order may stand in either place, so the order
should end in a key; a page beyond the end, and any page of an empty table, has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def write_paged(df: DataFrame, path: str, order: list[str]) -> None:
    """``df`` in ``order`` under ``path/rows``, its index under ``path/index``. Replaces what was there.

    The index is written last: without one (a job that died) there is no table to page.
    """
    spark = df.sparkSession
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/rows")
    key = F.struct(*order)
    files = (spark.read.schema(df.schema).parquet(f"{path}/rows")
             .groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
             .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key")))
    # one row a file passes this window
    before = Window.orderBy("first_key", "last_key", "file").rowsBetween(Window.unboundedPreceding, -1)
    (files.select("file", "n_rows", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_rank"))
     .write.mode("overwrite").parquet(f"{path}/index"))


def page_files(spark: SparkSession, path: str, offset: int, limit: int) -> list[tuple[int, str]]:
    """(rank of its first row, name) of each file that holds rows of the page, in order."""
    index = spark.read.parquet(f"{path}/index")
    hit = index.where((F.col("first_rank") < offset + limit) & (F.col("first_rank") + F.col("n_rows") > offset))
    return sorted((r.first_rank, r.file) for r in hit.select("first_rank", "file").collect())


def page_by_rank(spark: SparkSession, path: str, order: list[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset .. offset+limit-1`` of a table that ``write_paged`` wrote in ``order``."""
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit are counts of rows")
    files = page_files(spark, path, offset, limit)
    if not files:
        return spark.read.parquet(f"{path}/rows").limit(0)
    rows = spark.read.parquet(*(f"{path}/rows/{name}" for _, name in files))
    return rows.orderBy(*order).offset(offset - files[0][0]).limit(limit)


def n_rows(spark: SparkSession, path: str) -> int:
    """The table's rows, from its index."""
    return spark.read.parquet(f"{path}/index").agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def pages(spark: SparkSession, path: str, order: list[str], limit: int) -> Iterator[DataFrame]:
    """All pages of ``limit`` rows, in order."""
    if limit < 1:
        raise ValueError("a page has at least one row")
    for offset in range(0, n_rows(spark, path), limit):
        yield page_by_rank(spark, path, order, offset, limit)
