"""Every planned query of SURVEY section 2 as ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables through the source views and runs over
the whole tables. Parameters that the page or the jobs fix (the compared
tags, the batch size, the page offset) are the values below.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import compare as cmp
from ..operators import graph as g
from ..operators import merge as mg
from ..operators import rollup
from ..operators import skew
from ..operators import tags as t
from ..operators import totals as tot
from ..session import work_path
from ..sinks import bucketed
from ..sinks.pages import page_by_rank, write_paged
from ..sources import batches as b
from ..sources import lookup
from ..sources.fixtures import load_sources
from ..streaming.run_store import RunStore
from .jobs import merge_source
from .tables import TagTables

# Fixed parameters of the registered queries (FIXTURES.md section 4 and
# SURVEY section 8): the three compared tags, the id batch size, the page.
TECH = "red-plate"
TECH_WITH = "small-widget"
TECH_OR = "hot-ring"
BATCH_IDS = 3000
ID_SCANS = 5
PAGE_OFFSET = 1000
PAGE_ROWS = 500
RANGE_FIRST_DAY = "1996-01-01"
RANGE_LAST_DAY = "1996-12-31"
ROLLUP_FIRST_DAY = "1993-03-15"
ROLLUP_LAST_DAY = "1997-10-20"

Query = Callable[[SparkSession, str], DataFrame]


def tables(spark: SparkSession, sf_dir: str) -> TagTables:
    """The lazy tables over one folder (plans only)."""
    return TagTables(load_sources(spark, sf_dir))


def _mid(df: DataFrame, column: str = "id"):
    """Middle of the id range, as a scalar subquery: splits a table in two
    batches for the merge queries (both halves are used)."""
    return df.select(F.expr(f"(min({column}) + max({column})) div 2")).scalar()


# ---- sources and scans -------------------------------------------------------

def q_posts_tagged(spark, sf):
    return t.posts_tagged(load_sources(spark, sf).posts)


def q_max_id(spark, sf):
    return b.max_id(load_sources(spark, sf).posts)


def q_id_bounds(spark, sf):
    """S3 and S4 from footers: the posts' ids are the orders' keys."""
    orders = lookup.read_footers(spark, f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("id"))
    return lookup.id_bounds(orders)


def q_rel_count(spark, sf):
    return b.row_count(tables(spark, sf).tech_rel)


def _scans(spark, sf, windows: int) -> list[DataFrame]:
    """The tagged posts as half-open id range scans that together cover the
    whole table; the bounds come from a one-row probe of the ids."""
    posts = load_sources(spark, sf).posts
    low, high = posts.agg(F.min("id"), F.max("id")).first()
    if low is None:
        low, high = 0, 0
    size = -(-(high - low + 1) // windows)
    return [t.post_tags(b.id_batch(posts, a, z))
            .select("id", "day", "weight", F.lit(a).cast("bigint").alias("batch_low"),
                    F.lit(z).cast("bigint").alias("batch_high"))
            for a, z in ((low + k * size, low + (k + 1) * size) for k in range(windows))]


def q_id_batch(spark, sf):
    """Per range scan its bounds, posts and weight."""
    return (mg.union_batches(_scans(spark, sf, ID_SCANS)).groupBy("batch_low", "batch_high")
            .agg(F.count(F.lit(1)).alias("posts"), F.min("id").alias("first_id"),
                 F.max("id").alias("last_id"), F.sum("weight").cast("bigint").alias("weight")))


def q_id_batch_counts(spark, sf):
    return b.batch_counts(tables(spark, sf).post_tags, BATCH_IDS)


def q_three_batch_union(spark, sf):
    """S6 + U1: the range scans of one loop, united."""
    return mg.union_batches(_scans(spark, sf, b.BATCHES_PER_LOOP))


def q_rel_page(spark, sf):
    return b.page(tables(spark, sf).tech_rel, ["technode1", "technode2"], PAGE_OFFSET, PAGE_ROWS)


def q_rel_page_ranked(spark, sf):
    """S7 over a table written in its order: the page reads the files that hold its ranks."""
    path, order = work_path(spark, f"paged-{uuid.uuid4().hex}"), ["technode1", "technode2"]
    write_paged(tables(spark, sf).tech_rel, path, order)
    return page_by_rank(spark, path, order, PAGE_OFFSET, PAGE_ROWS)


def q_posts_commented(spark, sf):
    s = load_sources(spark, sf)
    keys = s.comments.where(F.col("user_id").isNotNull())
    return b.semi_by_keys(s.posts, "id", keys, "post_id").select("id", "tags")


def q_users_commenting(spark, sf):
    s = load_sources(spark, sf)
    keys = s.comments.where(F.col("user_id").isNotNull())
    return b.semi_by_keys(s.users, "id", keys, "user_id").select("id", "display_name",
                                                                 "website_url")


# ---- tag operators -----------------------------------------------------------

def q_tag_lists(spark, sf):
    return t.tag_lists(tables(spark, sf).post_tags)


def q_clean_tag_lists(spark, sf):
    return tot.clean_tag_lists(tables(spark, sf).post_tags)


def q_tag_tokens(spark, sf):
    return tables(spark, sf).tag_tokens


def q_tag_pairs(spark, sf):
    return tables(spark, sf).tag_pairs


def q_tech_rel(spark, sf):
    return tables(spark, sf).tech_rel


def q_tech_node(spark, sf):
    return tables(spark, sf).tech_node


def q_tag_date(spark, sf):
    return tables(spark, sf).tag_date


def q_tag_list(spark, sf):
    return tables(spark, sf).tag_list


def q_tag_year_counts(spark, sf):
    td = tables(spark, sf).tag_date
    return td.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.sum("app_num").cast("bigint").alias("app_num"))


# ---- comments and users ------------------------------------------------------

def q_comments_tagged(spark, sf):
    s = load_sources(spark, sf)
    return tot.comments_tagged(s.posts, s.comments, s.users)


def q_user_tech(spark, sf):
    return tables(spark, sf).user_tech


def _list_as_text(lists):
    """The list as text: the check compares plain columns."""
    item = F.transform("techs", lambda x: F.concat_ws(
        ":", x["tech"], x["score"].cast("string"), x["cnt"].cast("string")))
    return lists.withColumn("techs", F.array_join(item, ","))


def q_user_tech_list(spark, sf):
    return _list_as_text(tables(spark, sf).user_tech_list)


# ---- graph tables ------------------------------------------------------------

def q_graph_vertices(spark, sf):
    return tables(spark, sf).graph_vertices


def q_graph_edges(spark, sf):
    return tables(spark, sf).graph_edges


def q_graph_edges_joined(spark, sf):
    """J3 as it runs on stored tables: both ends of an edge looked up among the vertices."""
    tb = tables(spark, sf)
    return g.graph_edges(tb.tech_rel, tb.tech_node)


def q_user_vertices(spark, sf):
    return tables(spark, sf).user_vertices


def q_contribute_edges(spark, sf):
    return tables(spark, sf).contribute_edges


def q_repair_user_names(spark, sf):
    """F14 over all users, where every third user is stored the way the
    reference's faulty merge left it (a printed tuple in the name, D8)."""
    u = load_sources(spark, sf).users
    spoilt = F.concat(F.lit('("'), F.col("display_name"), F.lit('",'),
                      F.coalesce("website_url", F.lit("")), F.lit(",3)"))
    legacy = u.select("id", F.when(F.col("id") % 3 == 0, spoilt)
                      .otherwise(F.col("display_name")).alias("name"),
                      F.col("website_url").alias("website"))
    return g.repair_user_names(legacy)


# ---- merges ------------------------------------------------------------------

def _halves(spark, sf):
    """The tagged posts in two id batches, split at the middle of the posts'
    id range (like the max-id probe S3, over all posts: a scan of the ids)."""
    s = load_sources(spark, sf)
    pt = tables(spark, sf).post_tags
    mid = _mid(s.posts)
    return s, pt.where(F.col("id") < mid), pt.where(F.col("id") >= mid)


def _merged(spark, sf, name: str, build) -> DataFrame:
    _, old, new = _halves(spark, sf)
    return mg.merge_totals(build(old), build(new), mg.SPECS[name])


def q_merge_rel(spark, sf):
    return _merged(spark, sf, "tech_rel", tot.tech_rel)


def q_merge_node(spark, sf):
    return _merged(spark, sf, "tech_node", tot.tech_node)


def q_merge_date(spark, sf):
    return _merged(spark, sf, "tag_date", tot.tag_date)


def q_merge_list(spark, sf):
    return _merged(spark, sf, "tag_list", tot.tag_list)


def q_merge_user_tech(spark, sf):
    s = load_sources(spark, sf)
    pt = tables(spark, sf).post_tags
    mid = _mid(s.comments)
    old = tot.user_tech(pt, s.comments.where(F.col("id") < mid), s.users)
    new = tot.user_tech(pt, s.comments.where(F.col("id") >= mid), s.users)
    return mg.merge_totals(old, new, mg.SPECS["user_tech"])


def _renamed_user_tech(spark, sf):
    """USER_TECH merged from two halves of the comments, every third user being renamed between them."""
    s = load_sources(spark, sf)
    pt = tables(spark, sf).post_tags
    mid = _mid(s.comments)
    later = s.users.withColumn("display_name", F.when(
        F.col("id") % 3 == 1, F.concat("display_name", F.lit(" renamed"))).otherwise(F.col("display_name")))
    old = tot.user_tech(pt, s.comments.where(F.col("id") < mid), s.users)
    new = tot.user_tech(pt, s.comments.where(F.col("id") >= mid), later)
    return mg.merge_totals(old, new, mg.SPECS["user_tech"])


def q_renamed_user_list(spark, sf):
    return _list_as_text(tot.user_tech_list(_renamed_user_tech(spark, sf)))


def q_renamed_user_vertices(spark, sf):
    return g.user_vertices(_renamed_user_tech(spark, sf))


def q_insert_if_absent(spark, sf):
    _, old, new = _halves(spark, sf)
    return mg.insert_if_absent(tot.tech_rel(old), tot.tech_rel(new), ["technode1", "technode2"])


def q_user_tech_salted(spark, sf):
    """A6 with every third comment moved to the first post, whose comments are dealt out by the sketch."""
    s = load_sources(spark, sf)
    first = s.posts.select(F.expr("min(id)")).scalar()
    comments = s.comments.withColumn("post_id", F.when(F.col("id") % 3 == 0, first).otherwise(F.col("post_id")))
    hot = skew.heavy_keys(comments, "post_id")
    return tot.user_tech(t.post_tags(s.posts), comments, s.users, hot)


def q_user_tech_bucketed(spark, sf):
    """J1 and A6 over posts and comments that are stored in buckets of the post id."""
    s, root = load_sources(spark, sf), work_path(spark, f"bucketed-{uuid.uuid4().hex}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed.write_post_comments(t.post_tags(s.posts), s.comments, root, buckets)
    return bucketed.user_tech(spark, root, s.users)


def q_refreshed_edges(spark, sf):
    """T1 and K4 kept current: the edges of the first half of the posts, refreshed by the second."""
    _, old, new = _halves(spark, sf)
    before, delta = tot.tech_rel(old), tot.tech_rel(new)
    totals = mg.merge_totals(before, delta, mg.SPECS["tech_rel"])
    top = g.refresh_neighbours(g.top_neighbours(before), totals, delta)
    return top.select("technode1", "technode2", g.edge_name("technode1", "technode2").alias("name"), "weight", "cnt")


def _run_store(spark) -> RunStore:
    """A new store of runs in the shared folder."""
    return RunStore(spark, work_path(spark, f"runs-{uuid.uuid4().hex}"))


def q_run_store_rel(spark, sf):
    """A9 by runs: the whole table merged in windows of a fourth of the posts (equal depth),
    the runs compacted on the way, and what is left added up."""
    posts, store = load_sources(spark, sf).posts, _run_store(spark)
    quarter = max(1, -(-b.row_count(posts).first()["count_num"] // 4))
    merge_source(store, "posts", posts, quarter, lambda rows: {"tech_rel": tot.tech_rel(t.post_tags(rows))})
    found = store.table("tech_rel")
    return tot.tech_rel(t.post_tags(posts)) if found is None else found


def q_late_ids_node(spark, sf):
    """S5 with late ids: first the posts with an even weight arrive, then all others, whose ids
    lie between them. The second load merges what is new, once."""
    posts, store = load_sources(spark, sf).posts, _run_store(spark)
    half = max(1, -(-b.row_count(posts).first()["count_num"] // 2))
    early = t.post_tags(posts).where("weight % 2 = 0").select("id")
    for there in (b.semi_by_keys(posts, "id", early, "id"), posts):
        merge_source(store, "posts", there, half, lambda rows: {"tech_node": tot.tech_node(t.post_tags(rows))})
    found = store.table("tech_node")
    return tot.tech_node(t.post_tags(posts)) if found is None else found


# ---- comparison page ---------------------------------------------------------

def q_monthly_trend(spark, sf):
    return cmp.monthly_trend(tables(spark, sf).tag_date, TECH, TECH_WITH, TECH_OR)


def q_trend_extents(spark, sf):
    return cmp.trend_extents(q_monthly_trend(spark, sf))


def q_bar_extents(spark, sf):
    return cmp.bar_extents(q_compare_edge_long(spark, sf))


def q_compare_edge(spark, sf):
    tb = tables(spark, sf)
    return cmp.compare_edge(tb.tech_rel, tb.tech_node, TECH, [TECH_WITH, TECH_OR])


def q_compare_edge_long(spark, sf):
    return cmp.compare_edge_long(tables(spark, sf).tech_rel, TECH, [TECH_WITH, TECH_OR])


def q_common_contributors(spark, sf):
    return cmp.common_contributors(tables(spark, sf).user_tech, TECH, TECH_WITH)


def q_related_techs(spark, sf):
    return cmp.related_techs(tables(spark, sf).graph_edges, TECH, TECH_WITH)


def q_related_graph_nodes(spark, sf):
    return cmp.related_graph_nodes(tables(spark, sf).graph_edges, TECH, TECH_WITH)


def q_related_graph_edges(spark, sf):
    return cmp.related_graph_edges(tables(spark, sf).graph_edges, TECH, TECH_WITH)


def q_neighbourhood(spark, sf):
    tb = tables(spark, sf)
    return cmp.neighbourhood(tb.graph_edges, tb.tech_node, TECH)


def q_tech_rank_in_range(spark, sf):
    return cmp.tech_rank_in_range(tables(spark, sf).tag_date, RANGE_FIRST_DAY, RANGE_LAST_DAY)


def q_tag_rollup(spark, sf):
    return rollup.tag_rollup(tables(spark, sf).tag_date)


def q_rank_by_rollup(spark, sf):
    """Q3 over a long range with ragged ends: years, months and days."""
    days = tables(spark, sf).tag_date
    return rollup.tech_rank_in_range(days, rollup.tag_rollup(days), ROLLUP_FIRST_DAY, ROLLUP_LAST_DAY)


def q_trend_by_rollup(spark, sf):
    """R1 and A8 from the month nodes."""
    months = rollup.months(rollup.tag_rollup(tables(spark, sf).tag_date))
    return cmp.monthly_trend(months, TECH, TECH_WITH, TECH_OR)


def q_top_users_for_tech(spark, sf):
    return cmp.top_users_for_tech(tables(spark, sf).user_tech, TECH)


def _fresh(fn: Query) -> Query:
    """Every call returns a new Dataset (its own physical plan), so no
    executed plan or shuffle output is shared between calls."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir).select("*")
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    name[2:]: _fresh(fn) for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
