"""Posts and comments stored for their join (J1): bucketed and sorted on the post id.

Both tables are shuffled once, when they are written, into the same number of buckets. Every later
join reads bucket beside bucket, with no exchange below it. Comments of hot posts, which would
make one bucket a large share of the table, are stored apart, unbucketed, and joined with their few posts by
salts (``skew.salted_join``); the hot posts are named by a sketch of the comments when they are written.

The files keep their bucket numbers in their names, so any session can open them. The catalog entry
that says so is made for the opening and dropped with the frame in hand (the files
are external to the catalog and stay).

Results: comments without a post or a user are not stored, comments of unknown posts join with
nothing, columns beyond those named are left behind, empty tables join to an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.tags import split_tags
from ..operators.skew import SHARE, heavy_keys, salted_join
from ..operators.totals import scores_of, with_users

KEY = "post_id"


def _name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """``df`` as one file a bucket, sorted by ``key``: the shuffle deals rows as the buckets do."""
    spark, name = df.sparkSession, _name()
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def read_bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """The table with these ``columns`` that ``write_bucketed`` wrote, known as bucketed. (An empty
    one has no files, so that its columns can't be read from them.)"""
    name = _name()
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{where}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def write_post_comments(post_tags_df: DataFrame, comments: DataFrame, root: str, buckets: int,
                        share: float = SHARE) -> None:
    """Posts and comments under ``root``; their layout is written last, as the mark of a whole table."""
    spark = post_tags_df.sparkSession
    hot = heavy_keys(comments.where(F.col("user_id").isNotNull()), KEY, share)
    kind = comments.schema[KEY].dataType.simpleString()
    spark.createDataFrame(hot, f"{KEY} {kind}, salts int").coalesce(1).write.mode("overwrite").parquet(f"{root}/hot")
    c = (comments.where(F.col("user_id").isNotNull() & F.col(KEY).isNotNull())
         .select("id", KEY, "user_id", "score"))
    is_hot = F.col(KEY).isin([k for k, _ in hot]) if hot else F.lit(False)
    p = post_tags_df.select(F.col("id").alias(KEY), split_tags("techlist").alias("tags")).where(F.col(KEY).isNotNull())
    write_bucketed(p, f"{root}/posts", KEY, buckets)
    write_bucketed(c.where(~is_hot), f"{root}/comments", KEY, buckets)
    c.where(is_hot).write.mode("overwrite").parquet(f"{root}/hot_comments")
    layout = (buckets, columns_of(p), columns_of(c))
    (spark.createDataFrame([layout], "buckets int, posts string, comments string").coalesce(1)
     .write.mode("overwrite").parquet(f"{root}/layout"))


def commented(spark: SparkSession, root: str) -> DataFrame:
    """J1 over the stored tables: ``user_id, score, tags`` for each comment of a post."""
    layout = spark.read.parquet(f"{root}/layout").first()
    hot = [(r[KEY], r["salts"]) for r in spark.read.parquet(f"{root}/hot").collect()]
    posts, cold = (read_bucketed(spark, f"{root}/{name}", layout[name], KEY, layout["buckets"])
                   for name in ("posts", "comments"))
    cold = cold.join(posts, KEY)
    out = cold.select("user_id", "score", "tags")
    if not hot:
        return out
    hot_posts = spark.read.schema(layout["posts"]).parquet(f"{root}/posts").where(F.col(KEY).isin([k for k, _ in hot]))
    salted = salted_join(spark.read.parquet(f"{root}/hot_comments"), hot_posts, KEY, hot, "id")
    return out.unionByName(salted.select("user_id", "score", "tags"))


def user_tech(spark: SparkSession, root: str, users: DataFrame) -> DataFrame:
    """A6 from the stored tables: the rows of ``totals.user_tech``."""
    return with_users(scores_of(commented(spark, root)), users)
