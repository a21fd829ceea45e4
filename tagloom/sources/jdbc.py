"""JDBC sources (S1, S2, S5 over a database).

S1 -- the reference reads a sub-select with its column list and filter; with
``query`` the database runs the filter, and with ``dbtable`` plus ``where``
Spark pushes the filter into the generated SQL. S2 -- a parallel read splits
the id range into ``num_partitions`` strides (the reference passed a number
where a column name belongs; Spark needs the column). The bounds come from a
one-row probe that the database answers (S3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value of the reference's JDBC reads: partitions asked for.
JDBC_PARTITIONS = 18
FETCH_ROWS = 10_000          # rows per round trip to the database


def _reader(spark: SparkSession, url: str, properties: dict[str, str] | None):
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(FETCH_ROWS))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict[str, str] | None = None) -> DataFrame:
    """A table or a sub-select, read in one partition."""
    r = _reader(spark, url, properties)
    r = r.option("query", query) if query is not None else r.option("dbtable", table)
    return r.load()


def id_bounds(spark: SparkSession, url: str, table: str, column: str,
              properties: dict[str, str] | None = None) -> tuple[int | None, int | None]:
    """S3: MIN and MAX of the id column, computed by the database (one row)."""
    row = read_jdbc(spark, url, query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi "
                                      f"FROM {table}", properties=properties).first()
    return (None, None) if row is None else (row[0], row[1])


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str,
                          num_partitions: int = JDBC_PARTITIONS,
                          bounds: tuple[int, int] | None = None,
                          properties: dict[str, str] | None = None) -> DataFrame:
    """``num_partitions`` concurrent range queries over ``column``."""
    lo, hi = bounds or id_bounds(spark, url, table, column, properties)
    r = _reader(spark, url, properties).option("dbtable", table)
    if lo is None:
        return r.load()
    return (r.option("partitionColumn", column).option("lowerBound", str(lo))
            .option("upperBound", str(hi + 1)).option("numPartitions", str(num_partitions))
            .load())


def read_id_batch(spark: SparkSession, url: str, table: str, column: str, low: int, high: int,
                  num_partitions: int = JDBC_PARTITIONS,
                  properties: dict[str, str] | None = None) -> DataFrame:
    """S5 over JDBC: ``low <= id < high`` split into strides; every stride
    query carries the range, so the database reads only that batch."""
    r = (_reader(spark, url, properties).option("dbtable", table)
         .option("partitionColumn", column).option("lowerBound", str(low))
         .option("upperBound", str(high)).option("numPartitions", str(num_partitions)).load())
    return r.where((F.col(column) >= low) & (F.col(column) < high))
