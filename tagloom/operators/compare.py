"""The comparison page: one tag against two others, as DataFrame queries.

Each section of the page is a small query over the stored tables (tech_rel,
tech_node, tag_date, user_tech, graph_edges). Every query filters to the
named tags first, so the joins and sorts run on a handful of rows; the
top-k sorts are ``orderBy().limit()`` (a per-task top-k, then a merge).
Ties are fixed: ``related_*`` by the neighbour tag, contributors and users by
user id, ranks by tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.tags import month_index, month_label

# Fixed values of the page: contributor rows and neighbours shown.
CONTRIBUTORS_SHOWN = 4
RELATED_SHOWN = 10
RANK_SHOWN = 10
TOP_USERS_SHOWN = 10


def monthly_trend(tag_date_df: DataFrame, tech: str, tech_with: str, tech_or: str,
                  drop_last: bool = True) -> DataFrame:
    """R1 + A8 + P7 + P8 + F11 + F12 + T4: one row per month where any of the
    three tags occurs, their summed appNum side by side (0 when absent); the
    last month is dropped (D12); the years come from the data (D18). On a
    stored table the tag filter is pushed into the scan as an IN filter."""
    t = tag_date_df.where(F.col("tech").isin(tech, tech_with, tech_or))
    by_month = (t.groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
                .agg(*[F.coalesce(F.sum(F.when(F.col("tech") == name, F.col("app_num"))),
                                  F.lit(0)).cast("bigint").alias(alias)
                       for name, alias in ((tech, "tech"), (tech_with, "tech1"),
                                           (tech_or, "tech2"))]))
    m = F.col("year") * 12 + F.col("month")
    if drop_last:
        # a scalar subquery (one row, computed once), not a global window
        last = t.select(F.max(month_index("day"))).scalar()
        by_month = by_month.where(m < last)
    return by_month.orderBy("year", "month").select(
        month_label("year", "month").alias("date"), "year", "month",
        F.lit(tech).alias("tech_label"), F.lit(tech_with).alias("tech1_label"),
        F.lit(tech_or).alias("tech2_label"), "tech", "tech1", "tech2")


def trend_extents(trend: DataFrame) -> DataFrame:
    """First and last month and the largest of the three series."""
    first = F.make_date("year", "month", F.lit(1))
    return trend.agg(F.min(first).alias("first_month"), F.max(first).alias("last_month"),
                     F.max(F.greatest("tech", "tech1", "tech2")).cast("bigint").alias("max_value"))


def bar_extents(edge_long: DataFrame) -> DataFrame:
    """A12, bar chart: the largest value per rate (weight, count) over the
    pair-strength bars, which scales each chart."""
    return edge_long.groupBy("rate").agg(F.max("value").alias("max_value"))


def compare_edge(tech_rel_df: DataFrame, tech_node_df: DataFrame, tech: str,
                 others: list[str]) -> DataFrame:
    """R2 + J5: the edge tech -> other with both node records, per other tag.

    Both endpoints are looked up in one join: each edge row becomes its two
    ends, joined once to the vertices, and folded back per edge (an edge
    needs both ends, as with two inner joins). Two separate joins would let
    Spark push a different tag filter into each side, so the vertex totals
    would be computed twice from the posts; here they are computed once.
    """
    e = tech_rel_df.where((F.col("technode1") == tech) & F.col("technode2").isin(*others))
    ends = e.select("technode1", "technode2", "weight", "cnt",
                    F.explode(F.array(
                        F.struct(F.col("technode1").alias("node"), F.lit(1).alias("side")),
                        F.struct(F.col("technode2").alias("node"), F.lit(2).alias("side"))))
                    .alias("end"))
    v = tech_node_df.select(F.col("technode").alias("_node"), F.col("weight").alias("_w"),
                            F.col("cnt").alias("_c"))
    one = F.col("end.side") == 1
    two = F.col("end.side") == 2
    return (ends.join(v, ends["end.node"] == v["_node"])
            .groupBy("technode1", "technode2", "weight", "cnt")
            .agg(F.max(F.when(one, F.col("_w"))).alias("weight1"),
                 F.max(F.when(one, F.col("_c"))).alias("cnt1"),
                 F.max(F.when(two, F.col("_w"))).alias("weight2"),
                 F.max(F.when(two, F.col("_c"))).alias("cnt2"),
                 F.count(F.lit(1)).alias("_ends"))
            .where(F.col("_ends") == 2)
            .select("technode1", "technode2", "weight", "cnt", "weight1", "cnt1",
                    "weight2", "cnt2"))


def compare_edge_long(tech_rel_df: DataFrame, tech: str, others: list[str]) -> DataFrame:
    """Long form (category, rate, value) of the edges' weight and count."""
    e = (tech_rel_df.where((F.col("technode1") == tech) & F.col("technode2").isin(*others))
         .select(F.concat(F.lit("with "), "technode2").alias("category"),
                 F.col("weight"), F.col("cnt").alias("count")))
    return e.unpivot("category", ["weight", "count"], "rate", "value")


def common_contributors(user_tech_df: DataFrame, tech: str, tech_with: str,
                        shown: int = CONTRIBUTORS_SHOWN) -> DataFrame:
    """R4 + J6 + T2 + T3: users with both tags, by their score on the second
    tag, then on the first; the first ``shown`` rows (fewer if absent, D13)."""
    a = user_tech_df.where(F.col("tech") == tech).select("user_id", F.col("score").alias("a_score"))
    b = user_tech_df.where(F.col("tech") == tech_with)
    return (b.join(a, "user_id")
            .orderBy(F.col("score").desc(), F.col("a_score").desc(), F.col("user_id"))
            .limit(shown)
            .select("user_id", "user_name",
                    F.coalesce("user_website", F.lit("")).alias("user_web"),
                    F.col("score").alias("weight"), "cnt"))


def _related(graph_edges_df: DataFrame, tech: str, tech_with: str,
             shown: int = RELATED_SHOWN) -> DataFrame:
    """J7 + T2: neighbours with an edge to both tags, ranked (rk 1..shown)."""
    a = graph_edges_df.where(F.col("technode2") == tech).select(
        "technode1", F.col("name").alias("name1"), F.col("weight").alias("weight1"))
    b = graph_edges_df.where(F.col("technode2") == tech_with).select(
        "technode1", F.col("name").alias("name2"), F.col("weight").alias("weight2"))
    top = (a.join(b, "technode1")
           .orderBy(F.col("weight2").desc(), F.col("weight1").desc(), F.col("technode1"))
           .limit(shown))
    # the window runs over at most ``shown`` rows
    w = Window.orderBy(F.col("weight2").desc(), F.col("weight1").desc(), F.col("technode1"))
    return top.withColumn("rk", F.row_number().over(w))


def related_techs(graph_edges_df: DataFrame, tech: str, tech_with: str,
                  shown: int = RELATED_SHOWN) -> DataFrame:
    """Section 4 rows: ``tech, name1, weight1, name2, weight2``."""
    r = _related(graph_edges_df, tech, tech_with, shown)
    return r.select(F.col("technode1").alias("tech"), "name1", "weight1", "name2", "weight2")


def related_graph_nodes(graph_edges_df: DataFrame, tech: str, tech_with: str,
                        shown: int = RELATED_SHOWN) -> DataFrame:
    """R5 nodes: the two roots as 0 and 1, the neighbours from 2 on."""
    r = _related(graph_edges_df, tech, tech_with, shown)
    roots = (r.sparkSession.range(2)
             .select(F.col("id").cast("int").alias("id"),
                     F.when(F.col("id") == 0, F.lit(tech)).otherwise(F.lit(tech_with))
                     .alias("name")))
    return roots.unionByName(r.select((F.col("rk") + 1).cast("int").alias("id"),
                                      F.col("technode1").alias("name")))


def related_graph_edges(graph_edges_df: DataFrame, tech: str, tech_with: str,
                        shown: int = RELATED_SHOWN) -> DataFrame:
    """R5 edges: each neighbour linked to root 0 by its edge to ``tech`` and
    to root 1 by its edge to ``tech_with``."""
    r = _related(graph_edges_df, tech, tech_with, shown)
    links = F.array(F.struct(F.lit(0).alias("target"), F.col("name1").alias("name")),
                    F.struct(F.lit(1).alias("target"), F.col("name2").alias("name")))
    return (r.select((F.col("rk") + 1).cast("int").alias("source"), F.explode(links).alias("l"))
            .select("source", F.col("l.target").cast("int").alias("target"), "l.name"))


def neighbourhood(graph_edges_df: DataFrame, tech_node_df: DataFrame, keyword: str) -> DataFrame:
    """Q1: the pruned neighbours of a tag, with their node records."""
    e = graph_edges_df.where(F.col("technode1") == keyword)
    v = tech_node_df.select(F.col("technode").alias("technode2"),
                            F.col("weight").alias("node_weight"), F.col("cnt").alias("node_cnt"))
    return e.join(v, "technode2").select(
        F.col("technode2").alias("name"), "node_weight", "node_cnt",
        F.col("name").alias("edge_name"), "weight", "cnt")


def top_ranks(counts: DataFrame, shown: int = RANK_SHOWN) -> DataFrame:
    """Tags ranked by their summed ``app_num``; ties by tag."""
    t = (counts.groupBy("tech").agg(F.sum("app_num").cast("bigint").alias("value"))
         .orderBy(F.col("value").desc(), F.col("tech")).limit(shown))
    w = Window.orderBy(F.col("value").desc(), F.col("tech"))
    return t.select(F.col("tech").alias("text"), "value",
                    F.row_number().over(w).cast("int").alias("rank"))


def tech_rank_in_range(tag_date_df: DataFrame, first_day: str, last_day: str,
                       shown: int = RANK_SHOWN) -> DataFrame:
    """Q3: tags ranked by summed appNum between two days (inclusive).

    The same range on ``year`` (implied by the days) lets a year-partitioned
    table skip every other year's folder."""
    d1, d2 = F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))
    t = tag_date_df.where(F.col("day").between(d1, d2))
    if "year" in tag_date_df.columns:
        t = t.where(F.col("year").between(F.year(d1), F.year(d2)))
    return top_ranks(t, shown)


def top_users_for_tech(user_tech_df: DataFrame, keyword: str,
                       shown: int = TOP_USERS_SHOWN) -> DataFrame:
    """Q4 + T5: the ``shown`` users of a tag with the highest score, returned
    in the order the page draws its bars: ascending by score (a sort of
    ``shown`` rows after the per-task top-k)."""
    return (user_tech_df.where(F.col("tech") == keyword)
            .orderBy(F.col("score").desc(), F.col("user_id")).limit(shown)
            .orderBy(F.col("score"), F.col("user_id").desc())
            .select("user_id", F.col("user_name").alias("name"),
                    F.coalesce("user_website", F.lit("")).alias("url_web"),
                    F.col("score").alias("value"), "cnt"))
