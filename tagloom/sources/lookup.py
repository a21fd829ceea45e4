"""Probes from file footers (S3, S4) and fetches of few keys by bloom filters.

``read_footers`` opens Parquet files with the reader that answers ``min``, ``max`` and
``count`` from footers (``spark.sql.parquet.aggregatePushdown``, which the package's
session settings switch on; without it the same query scans the column). It is for keys: a file
whose column is null throughout has no minimum in its footer, and Spark ends such a probe
with an error; read that table with ``spark.read.parquet`` instead.

``write_keyed`` writes a table with a bloom filter on its key in each row group, and
``fetch_keys`` reads the rows of given keys: up to ``MOST_KEYS`` as pushed-down equality
filters, so row groups whose filter rules the keys out are not read; more keys, or a table
of keys, by a semi join. Null and repeated keys, and keys that are not there, give nothing more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .batches import semi_by_keys

MOST_KEYS = 500
PUSHED = 10        # values of one IN that Spark pushes down one by one (its default)
V1_SOURCES = "spark.sql.sources.useV1SourceList"


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` for probes. The session's setting is as before afterwards."""
    before = spark.conf.get(V1_SOURCES)
    spark.conf.set(V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, before)


def id_bounds(df: DataFrame, column: str = "id") -> DataFrame:
    """Smallest and largest id and the rows, one row; null, null and 0 of an empty table
    (a count from the footers of no rows would be null)."""
    count = F.greatest(F.count(F.lit(1)), F.lit(0).cast("bigint"))
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"), count.alias("count_num"))


def write_keyed(df: DataFrame, path: str, key: str, rows_per_group: int = 1 << 20,
                group_bytes: int = 128 << 20) -> None:
    """Write ``df`` with a bloom filter on ``key``, sized for ``rows_per_group`` keys a row group."""
    (df.write.option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(rows_per_group))
     .option("parquet.block.row.count.limit", str(rows_per_group))
     .option("parquet.block.size", str(group_bytes)).parquet(path))


def fetch_keys(df: DataFrame, column: str, keys: list[int] | DataFrame, key: str = "key") -> DataFrame:
    """The rows of ``df`` whose ``column`` is among ``keys`` (a list, or column ``key`` of a table)."""
    if isinstance(keys, DataFrame):
        return semi_by_keys(df, column, keys, key)
    wanted = sorted({k for k in keys if k is not None})
    if len(wanted) > MOST_KEYS:
        table = df.sparkSession.createDataFrame([(k,) for k in wanted], f"{key} bigint")
        return semi_by_keys(df, column, table, key)
    test = F.lit(False)
    for i in range(0, len(wanted), PUSHED):
        test = test | F.col(column).isin(wanted[i:i + PUSHED])
    return df.where(test)
