"""Question-and-answer sources with their original column names.

A user of the original jobs has Posts, Comments and Users tables with the
dump's column names. These readers map them onto the package schema
(``fixtures.SCHEMAS``), from Parquet or over JDBC. Only the listed columns
are read (column pruning, or the column list of the JDBC sub-select), and
the row filters of the original sub-selects (``Tags IS NOT NULL``,
``UserId IS NOT NULL``) are pushed into the scan or the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .fixtures import SCHEMAS, Sources
from .jdbc import JDBC_PARTITIONS, read_jdbc_partitioned

# The source tables' column names, mapped to ours.
RAW_COLUMNS = {
    "posts": {"Id": "id", "Tags": "tags", "AnswerCount": "answer_count",
              "CommentCount": "comment_count", "FavoriteCount": "favorite_count",
              "CreationDate": "creation_date"},
    "comments": {"Id": "id", "Score": "score", "UserId": "user_id", "PostId": "post_id"},
    "users": {"Id": "id", "DisplayName": "display_name", "WebsiteUrl": "website_url"},
}


def _types(kind: str) -> dict[str, str]:
    return dict(f.strip().split(" ", 1) for f in SCHEMAS[kind].split(","))


def normalize(df: DataFrame, kind: str) -> DataFrame:
    """Select and rename the original columns, cast to the package types."""
    types = _types(kind)
    return df.select(*[F.col(raw).cast(types[ours]).alias(ours)
                       for raw, ours in RAW_COLUMNS[kind].items()])


def read_sources(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> Sources:
    """Posts / Comments / Users files (any format Spark reads) by kind."""
    frames = {kind: normalize(spark.read.format(fmt).load(path), kind)
              for kind, path in paths.items()}
    return Sources(frames["posts"], frames["comments"], frames["users"])


def read_sources_jdbc(spark: SparkSession, url: str, tables: dict[str, str],
                      properties: dict[str, str] | None = None,
                      num_partitions: int = JDBC_PARTITIONS, quote: str = '"') -> Sources:
    """S1 + S2 per table: a parallel range read over ``Id``; the ``where``
    on the frame is pushed into every partition's query."""
    def one(kind: str) -> DataFrame:
        df = read_jdbc_partitioned(spark, url, tables[kind], f"{quote}Id{quote}",
                                   num_partitions=num_partitions, properties=properties)
        return normalize(df, kind)
    return Sources(one("posts"), one("comments"), one("users"))
