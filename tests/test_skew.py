"""Hot keys by a sketch, dealt out before a join."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.operators import totals as tot
from tagloom.operators.skew import heavy_keys, salted_join
from tagloom.streaming.incremental import comment_batch_deltas

COMMENTS = "id long, score int, user_id long, post_id long"


@pytest.fixture()
def no_aqe_skew(spark):
    """Sixteen shuffle partitions, none split, coalesced or broadcast."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def half_hot(spark, n=40_000):
    """Half of the comments on post 7, the others on 5,000 posts."""
    return spark.range(n).select(
        "id", F.lit(1).alias("score"), (F.col("id") % 300).alias("user_id"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000).cast("long").alias("post_id"))


def test_heavy_keys_are_found_with_their_share(spark):
    hot = dict(heavy_keys(half_hot(spark), "post_id", 0.01))
    assert list(hot) == [7] and hot[7] in (50, 51)
    assert heavy_keys(half_hot(spark).limit(0), "post_id") == []
    nulls = half_hot(spark).withColumn("post_id", F.when(F.col("post_id") != 7, F.col("post_id")))
    assert heavy_keys(nulls, "post_id", 0.01) == []


def test_no_hot_key_is_missed_among_many_others(spark):
    """Two hundred keys above the share between half a million single ones."""
    df = spark.range(1_000_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 400).otherwise(F.col("id") + 1000)
                                       .alias("k"))
    hot = dict(heavy_keys(df, "k", 0.002))
    assert set(hot) == {2 * k for k in range(200)} and set(hot.values()) <= {2}


def test_a_post_with_half_of_the_comments_spreads_over_all_tasks(spark, no_aqe_skew):
    comments = half_hot(spark)
    posts = spark.range(6000).select(F.col("id").alias("post_id"), F.concat(F.lit("t"), F.col("id")).alias("tag"))
    hot = heavy_keys(comments, "post_id")
    joined = salted_join(comments, posts, "post_id", hot, "id")
    per_task = {r.p: r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    assert len(per_task) == 16 and max(per_task.values()) < 1.6 * 40_000 / 16
    on_hot = joined.where("post_id = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(on_hot) == 16
    plain = comments.join(posts, "post_id")
    assert rows(joined.select(plain.columns)) == rows(plain)


def test_repeated_rows_null_keys_and_missing_posts(spark):
    comments = spark.createDataFrame([(1, 1, 1, 5), (1, 1, 1, 5), (None, 2, 1, 5), (3, 3, 1, None), (4, 4, 1, 9)],
                                     COMMENTS)
    posts = spark.createDataFrame([(5, "a"), (5, "b"), (None, "c")], "post_id long, tag string")
    plain = comments.join(posts, "post_id")
    for hot in ([], [(5, 3)], [(5, 1), (9, 4), (77, 2)]):
        got = salted_join(comments, posts, "post_id", hot, "id").select(plain.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert salted_join(comments.limit(0), posts, "post_id", [(5, 2)], "id").count() == 0


def test_user_tech_of_a_hot_post(spark, make_posts):
    """The batch's probe names the hot post; totals are those of the plain join."""
    from tagloom.operators import tags as t
    posts = make_posts([(k, f"<a><b{k % 9}>", 1, 0, 0, "2012-01-02") for k in range(200)])
    users = spark.range(300).select("id", F.concat(F.lit("u"), "id").alias("display_name"),
                                    F.lit(None).cast("string").alias("website_url"))
    comments = half_hot(spark, 4000)
    want = rows(tot.user_tech(t.post_tags(posts), comments, users), "user_id", "tech", "score", "cnt")
    got = comment_batch_deltas(comments, posts, users)["user_tech"]
    assert rows(got, "user_id", "tech", "score", "cnt") == want
    assert comment_batch_deltas(comments.limit(0), posts, users)["user_tech"].count() == 0
