"""Plan checks: the queries stay JVM-side, filters reach the scan, year
filters prune partitions, top-k is limited before the shuffle."""

import pytest
from conftest import SF001

from tagloom.operators import totals as tot
from tagloom.plans.queries import QUERIES
from tagloom.plans.tables import TagTables
from tagloom.sinks.writers import read_year_table, write_table
from tagloom.sources import batches as b
from tagloom.sources.fixtures import load_sources


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in p, f"{name} runs Python: {node}"


def test_id_batch_pushed_to_parquet(spark, scratch):
    src = load_sources(spark, SF001)
    path = f"{scratch}/posts"
    write_table(src.posts, path)
    p = plan(b.id_batch(spark.read.parquet(path), 300, 600))
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,300), LessThan(id,600)]" in p


def test_year_filter_prunes_partitions(spark, scratch):
    tables = TagTables(load_sources(spark, SF001))
    path = f"{scratch}/tag_date"
    write_table(tables.tag_date, path, partition_by=("year",))
    df = read_year_table(spark, path, [1996])
    p = plan(df)
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p
    assert df.select("year").distinct().collect()[0][0] == 1996


def test_top_k_limited_before_shuffle(spark):
    p = plan(QUERIES["graph_edges"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_reads_only_needed_columns(spark):
    tables = TagTables(load_sources(spark, SF001))
    p = plan(tot.tech_rel(tables.post_tags))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "l_extendedprice" not in p


def test_mirror_is_one_pass(spark):
    """The mirrored TECH_REL aggregates the half pairs once, also under a
    node filter (the page's lookups)."""
    from pyspark.sql import functions as F
    tables = TagTables(load_sources(spark, SF001))
    for df in (tables.tech_rel, tables.tech_rel.where(F.col("technode1") == "red-plate")):
        df.collect()
        p = plan(df).split("== Initial Plan ==")[0]
        assert p.count("Exchange hashpartitioning(tech1") == 1


def test_hot_post_join_is_split(spark, scratch):
    """One post holding half of all comments: AQE splits its join partition
    (map-output blocks of the hot key go to several tasks)."""
    from pyspark.sql import functions as F

    from tagloom.operators import tags as t
    src = load_sources(spark, SF001.replace("0.001", "0.01"))
    src.posts.write.parquet(f"{scratch}/posts")
    hot = src.comments.withColumn(
        "post_id", F.when(F.col("id") % 2 == 0, F.lit(42)).otherwise(F.col("post_id")))
    hot.repartition(16).write.parquet(f"{scratch}/comments")
    conf = {"spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        posts = spark.read.parquet(f"{scratch}/posts")
        comments = spark.read.parquet(f"{scratch}/comments")
        df = tot.user_tech(t.post_tags(posts), comments, src.users)
        got = df.collect()
        assert "SortMergeJoin(skew=true)" in plan(df)
        want = tot.user_tech(t.post_tags(posts), comments.repartition(3), src.users).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_day_range_prunes_year_partitions(spark, scratch):
    from tagloom.operators import compare as cmp
    tables = TagTables(load_sources(spark, SF001))
    path = f"{scratch}/tag_date"
    write_table(tables.tag_date, path, partition_by=("year",), cluster_by=("day", "tech"))
    df = cmp.tech_rank_in_range(spark.read.parquet(path), "1996-01-01", "1996-12-31")
    df.collect()
    p = plan(df)
    assert "PartitionFilters: [isnotnull(year" in p and "(year#" in p
    assert rows_equal(df, cmp.tech_rank_in_range(tables.tag_date, "1996-01-01", "1996-12-31"))


def rows_equal(a, b) -> bool:
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_compare_edge_aggregates_vertices_once(spark):
    df = QUERIES["compare_edge"](spark, SF001)
    df.collect()
    p = plan(df).split("== Initial Plan ==")[0]
    # one shuffle for the vertex totals (grouped by tag), one for the pairs
    assert p.count("Exchange hashpartitioning(tag") == 1
    assert p.count("Exchange hashpartitioning(tech1") == 1


def test_trend_tag_filter_reaches_stored_scan(spark, scratch):
    from tagloom.operators import compare as cmp
    tables = TagTables(load_sources(spark, SF001))
    write_table(tables.tag_date, f"{scratch}/tag_date", partition_by=("year",),
                cluster_by=("day", "tech"))
    df = cmp.monthly_trend(spark.read.parquet(f"{scratch}/tag_date"),
                           "red-plate", "small-widget", "hot-ring")
    df.collect()
    assert "In(tech, [hot-ring,red-plate,small-widget])" in plan(df)
