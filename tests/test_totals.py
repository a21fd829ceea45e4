"""Rewrites W1 / W2 against the literal pair-table forms, and the properties
"""

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from tagloom.operators import tags as t
from tagloom.operators import totals as tot
from tagloom.sources.fixtures import load_sources


@pytest.fixture(scope="module")
def src(spark):
    return load_sources(spark, SF001)


@pytest.fixture(scope="module")
def pt(src):
    return t.post_tags(src.posts).cache()


def test_counts_match_fixture_table(src, pt):
    assert src.posts.count() == 1500
    assert src.posts.where("tags is null").count() == 27
    assert src.comments.count() == 6000
    assert src.comments.where("user_id is null").count() == 918
    assert pt.count() == 1473
    assert t.tag_pairs(pt).count() == 21704


def test_w2_equals_pair_table(pt):
    assert rows(tot.tech_rel(pt)) == rows(tot.tech_rel_from_pairs(t.tag_pairs(pt)))


def test_w1_equals_pair_table(pt):
    pairs = t.tag_pairs(pt)
    assert rows(tot.tech_node(pt)) == rows(tot.tech_node_from_pairs(pairs))
    assert rows(tot.tag_date(pt)) == rows(tot.tag_date_from_pairs(pairs))


def test_many_units_on_whole_table(pt):
    """Posts dealt out token by token give the same totals as whole ones."""
    assert rows(tot.tech_rel(pt, unit_tokens=1)) == rows(tot.tech_rel(pt))
    assert rows(t.tag_pairs(pt, unit_tokens=2)) == rows(t.tag_pairs(pt))


def test_fixture_sums(pt):
    rel = tot.tech_rel(pt).agg(F.sum("weight"), F.count("*")).first()
    assert tuple(rel) == (5_751_280, 3_494)
    node = tot.tech_node(pt).agg(F.sum("weight"), F.sum("cnt")).first()
    assert tuple(node) == (1_272_292, 5_657)


def test_pair_row_identity(pt):
    n_pairs = t.tag_pairs(pt).count()
    assert tot.tech_rel(pt).agg(F.sum("cnt")).first()[0] == n_pairs
    assert tot.tag_date(pt).agg(F.sum("app_num")).first()[0] == n_pairs


def test_tech_rel_symmetric(pt):
    rel = tot.tech_rel(pt)
    mirrored = rel.select(F.col("technode2").alias("technode1"),
                          F.col("technode1").alias("technode2"), "weight", "cnt")
    assert rows(rel) == rows(mirrored)


def test_node_count_at_most_posts(pt):
    assert tot.tech_node(pt).agg(F.max("cnt")).first()[0] <= pt.count()


def test_tag_list_sizes(pt):
    tl = tot.tag_list(pt)
    assert tl.count() == 1473
    assert tl.agg(F.sum("app_num")).first()[0] == 1473


def test_user_tech_counts(src, pt):
    ut = tot.user_tech(pt, src.comments, src.users)
    assert ut.count() == 620
    # every (comment, token) row counted once
    ct = tot.comments_tagged(src.posts, src.comments, src.users)
    n = ct.select(F.size(F.filter(F.split(F.trim(F.regexp_replace("tags", "[<>]+", " ")), " "),
                                  lambda x: x != "")).alias("k")).agg(F.sum("k")).first()[0]
    assert ut.agg(F.sum("cnt")).first()[0] == n


def test_user_tech_list_order(spark):
    ut = spark.createDataFrame(
        [(1, "u", None, "b", 5, 1), (1, "u", None, "a", 5, 2), (1, "u", None, "c", 9, 1)],
        "user_id bigint, user_name string, user_website string, tech string, score bigint, "
        "cnt bigint")
    assert rows(tot.user_tech_list(ut), "techs") == [([("c", 9, 1), ("a", 5, 2), ("b", 5, 1)],)]


def test_vertex_semi_join_is_noop_for_same_posts(pt):
    """J3 cannot remove an edge when edges and vertices come from the same
    posts, which is why TagTables skips it."""
    from tagloom.operators import graph as g
    rel, node = tot.tech_rel(pt), tot.tech_node(pt)
    assert rows(g.graph_edges(rel, None)) == rows(g.graph_edges(rel, node))
    ends = rel.select("technode1").union(rel.select("technode2")).distinct()
    assert ends.join(node, ends.technode1 == node.technode, "left_anti").count() == 0
