"""Sinks: Parquet tables (year-partitioned where the reference had one table
per year) and JDBC tables.

K1 -- the reference wrote each partition through its own connection with a
hand-built ``INSERT``; here a write is one Spark job with the file or JDBC
committer. K2 -- the per-year tables DATE_2008..DATE_2018 become one table
partitioned by ``year``; a filter on ``year`` prunes directories on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.merge import SPECS

JDBC_BATCH_ROWS = 1000
JDBC_WRITERS = 18            # connections a write opens at most

# The order each stored table is kept in: first the column its lookups filter
# by, then the rest of its key, so that a hot tag still spans many tasks and files.
CLUSTER = {
    "tech_rel": ("technode1", "technode2"),
    "tag_date": ("year", "tech", "day"),
    "tag_rollup": ("year", "level", "day", "tech"),
    "tag_list": ("year", "day", "techlist"),
    "user_tech": ("tech", "user_id"),
    "graph_edges": ("technode2", "technode1"),
    "contribute_edges": ("tech", "user_id"),
}

# Tables that are derived, not merged, and kept in folders.
FOLDERS = {"tag_rollup": ("year",)}


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] | list[str] = (),
                cluster_by: tuple[str, ...] | list[str] = ()) -> None:
    """K1: one Parquet table. An overwrite replaces the whole table, whatever the
    session's partition overwrite mode: no partition of an older build stays.

    With ``partition_by`` or ``cluster_by`` the rows are range-partitioned on
    those columns and sorted in each task: Spark samples the keys for
    balanced bounds, so each task writes to one or two partition folders
    (few files) and a hot year or tag is still spread over many tasks --
    hashing on the partition column alone would put a whole year in one.
    A lookup by the first cluster column then skips the row groups outside
    its range (Parquet minimum and maximum).
    """
    by = [*partition_by, *(c for c in cluster_by if c not in partition_by)]
    if by:
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    w.parquet(path)


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every stored table under ``root/<name>``; returns the paths."""
    out = {}
    for name, df in tables.items():
        spec = SPECS.get(name)
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path, mode, spec.partition_by if spec else FOLDERS.get(name, ()), CLUSTER.get(name, ()))
        out[name] = path
    return out


def read_year_table(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The union of the year tables is the partitioned table itself; the
    ``year`` filter becomes a PartitionFilter (only those directories are
    listed and read)."""
    df = spark.read.parquet(path)
    return df.where(F.col("year").isin(*years)) if years else df


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict[str, str] | None = None,
               batch_rows: int = JDBC_BATCH_ROWS, num_partitions: int = JDBC_WRITERS) -> None:
    """K1 over JDBC: every task inserts its rows in batches of ``batch_rows``
    in one transaction; ``num_partitions`` caps the concurrent connections."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_rows)).option("numPartitions", str(num_partitions)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
