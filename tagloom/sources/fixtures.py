"""Source views Posts / Comments / Users over the driver's parquet tables.

The question-and-answer sources are projected from the TPC-H-like tables:
tag = ``part.p_name`` with the blank turned into ``-``; post = order;
comment = line item; user = supplier (see FIXTURES.md section 3). In
production the same three frames come from parquet or JDBC with the schemas
in ``SCHEMAS``; every operator only depends on those columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMAS = {
    "posts": "id bigint, tags string, answer_count int, comment_count int, "
             "favorite_count int, creation_date timestamp_ntz",
    "comments": "id bigint, score int, user_id bigint, post_id bigint",
    "users": "id bigint, display_name string, website_url string",
}

# Fixed values of the fixture projection (FIXTURES.md section 3): which rows
# get a NULL so that every null path runs.
NULL_FAVORITE_EVERY = 5      # favorite_count is NULL when o_orderkey % 5 = 0
NULL_USER_LINE = 7           # comments.user_id is NULL on line number 7
NULL_WEBSITE_EVERY = 4       # website_url is NULL when s_suppkey % 4 = 0
WEBSITE_PREFIX = "http://example.com/u"


@dataclass(frozen=True)
class Sources:
    posts: DataFrame
    comments: DataFrame
    users: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.parquet(path)


def posts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a tag string built from their line items' parts.

    One aggregation per order: the sorted distinct tags and the three counts
    are all sums over the order's lines, so a single shuffle on the order key
    (with map-side partial aggregation) builds them.
    """
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("tag"), "p_size")
    per_post = (lines.join(parts, lines.l_partkey == parts.p_partkey)
                .groupBy("l_orderkey")
                .agg(F.array_sort(F.collect_set("tag")).alias("tag_set"),
                     F.count(F.lit(1)).alias("n"),
                     F.sum(F.col("l_quantity").cast("int")).alias("q"),
                     F.sum("p_size").alias("s")))
    per_post = per_post.select(
        "l_orderkey",
        F.concat(F.lit("<"), F.array_join("tag_set", "><"), F.lit(">")).alias("tags"),
        F.col("n").cast("int").alias("answer_count"),
        F.col("q").cast("int").alias("comment_count"),
        F.when(F.col("l_orderkey") % NULL_FAVORITE_EVERY == 0, F.lit(None))
         .otherwise(F.col("s")).cast("int").alias("favorite_count"))
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("creation_date"))
    return (orders.join(per_post, orders.id == per_post.l_orderkey, "left")
            .select("id", "tags", "answer_count", "comment_count", "favorite_count",
                    F.col("creation_date").cast("timestamp_ntz").alias("creation_date")))


def comments_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.col("l_quantity").cast("int").alias("score"),
        F.when(F.col("l_linenumber") == NULL_USER_LINE, F.lit(None))
         .otherwise(F.col("l_suppkey")).cast("bigint").alias("user_id"),
        F.col("l_orderkey").cast("bigint").alias("post_id"))


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("id"),
        F.col("s_name").alias("display_name"),
        F.when(F.col("s_suppkey") % NULL_WEBSITE_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(WEBSITE_PREFIX), F.col("s_suppkey").cast("string")))
         .alias("website_url"))


def load_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(posts_view(spark, sf_dir), comments_view(spark, sf_dir),
                   users_view(spark, sf_dir))
