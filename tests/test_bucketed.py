"""Posts and comments in buckets of the post id."""

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from tagloom.operators import tags as t
from tagloom.operators import totals as tot
from tagloom.plans.jobs import run_build, run_user_tech
from tagloom.sinks import bucketed as bk
from tagloom.sources.fixtures import Sources, load_sources


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Sides of any size: the join has to come from the buckets."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    held = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in held.items():
        spark.conf.set(n, v)


def test_no_exchange_below_the_join(spark, scratch, no_broadcast):
    s = load_sources(spark, SF001)
    bk.write_post_comments(t.post_tags(s.posts), s.comments, scratch, 6, share=0.5)
    joined = bk.commented(spark, scratch)
    p = plan(joined)
    assert "SortMergeJoin" in p and "Exchange" not in p and "SelectedBucketsCount: 6 out of 6" in p
    assert "Exchange" in plan(s.comments.join(t.post_tags(s.posts).withColumnRenamed("id", "post_id"), "post_id"))
    assert rows(bk.user_tech(spark, scratch, s.users)) == rows(tot.user_tech(t.post_tags(s.posts), s.comments, s.users))
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("bucketed_")]


def test_hot_posts_stand_apart(spark, scratch, no_broadcast):
    """Half of the comments on one post: no bucket holds them, the rows are the same."""
    s = load_sources(spark, SF001)
    first = s.posts.agg(F.min("id")).first()[0]
    comments = s.comments.withColumn("post_id", F.when(F.col("id") % 2 == 0, first).otherwise(F.col("post_id")))
    bk.write_post_comments(t.post_tags(s.posts), comments, scratch, 6, share=0.05)
    n = comments.where("user_id is not null").count()
    sizes = [r["count"] for r in spark.read.parquet(f"{scratch}/comments").groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < n / 6 and spark.read.parquet(f"{scratch}/hot_comments").count() > n / 3
    assert rows(bk.user_tech(spark, scratch, s.users)) == rows(tot.user_tech(t.post_tags(s.posts), comments, s.users))


def test_odd_rows_and_empty_tables(spark, scratch):
    s = load_sources(spark, SF001)
    pt = t.post_tags(s.posts)
    odd = s.comments.limit(3).select(*[F.lit(None).cast("bigint").alias(c) if c == "post_id" else F.col(c) for c in s.comments.columns])
    lost = s.comments.limit(2).withColumn("post_id", F.lit(-5).cast("bigint"))
    twice = s.comments.unionByName(odd).unionByName(lost).unionByName(s.comments.limit(50)).withColumn("tags", F.lit("x"))
    bk.write_post_comments(pt, twice, f"{scratch}/odd'name", 4)
    assert rows(bk.user_tech(spark, f"{scratch}/odd'name", s.users)) == rows(tot.user_tech(pt, twice, s.users))
    for k, (p, c) in enumerate(((pt.where("false"), s.comments), (pt, s.comments.where("false")))):
        bk.write_post_comments(p, c, f"{scratch}/e{k}", 4)
        assert rows(bk.user_tech(spark, f"{scratch}/e{k}", s.users)) == []


def test_build_with_buckets_and_renamed_users(spark, scratch):
    s = load_sources(spark, SF001)
    paths = run_build(spark, s, f"{scratch}/b", buckets=4)
    want = tot.user_tech(t.post_tags(s.posts), s.comments, s.users)
    assert rows(spark.read.parquet(paths["user_tech"]), *want.columns) == rows(want)
    renamed = s.users.withColumn("display_name", F.concat("display_name", F.lit("!")))
    again = spark.read.parquet(run_user_tech(spark, f"{scratch}/b", renamed, f"{scratch}/again"))
    assert rows(again, *want.columns) == rows(tot.user_tech(t.post_tags(s.posts), s.comments, renamed))
