"""The tag graph as four tables: vertices, edges, user vertices, user edges.

The reference exported these to a graph store; here they are DataFrames
(written as Parquet by ``sinks``) and the page queries are joins over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.tags import (ascii_only, edge_name, repaired_name, repaired_website)

# Fixed value of the reference: edges kept per source tag.
EDGES_PER_TAG = 25

#: Touched tags that a batch's refresh sends to a scan as values.
FEW_TAGS = 200


def graph_vertices(tech_node_df: DataFrame) -> DataFrame:
    """K3: ``name, weight, cnt``."""
    return tech_node_df.select(F.col("technode").alias("name"), "weight", "cnt")


def top_neighbours(tech_rel_df: DataFrame, k: int = EDGES_PER_TAG) -> DataFrame:
    """The k heaviest edges of every source tag, ties by target.

    ``row_number() <= k`` over a window is planned as a WindowGroupLimit, which
    keeps at most k rows per key in each task before the shuffle.
    """
    w = Window.partitionBy("technode1").orderBy(F.col("weight").desc(), F.col("technode2"))
    return (tech_rel_df.withColumn("_rk", F.row_number().over(w))
            .where(F.col("_rk") <= k).drop("_rk"))


def refresh_neighbours(top: DataFrame, tech_rel_df: DataFrame, delta: DataFrame,
                       k: int = EDGES_PER_TAG, few: int = FEW_TAGS) -> DataFrame:
    """T1 kept current: ``top_neighbours(tech_rel_df, k)``, from the ``top`` before a batch.

    ``delta`` is the batch's TECH_REL and ``tech_rel_df`` the totals with it. Weights that only
    grow keep an untouched pair outside once k others stand before it, so a touched tag's new
    edges are among its old ones and the batch's pairs: only those pairs' totals are looked up.
    A tag with a pair that lost weight is ranked anew from all its totals. Up to ``few``
    touched tags go to the totals' scan as a filter; more are a join. Other tags' edges are
    copied. An empty batch gives ``top``; an empty ``top`` is right for a first batch only.
    """
    pair = ["technode1", "technode2"]
    columns = [*pair, "weight", "cnt"]
    tags = delta.select("technode1").distinct()
    found = [r[0] for r in tags.limit(few + 1).collect()]
    if not found:
        return top.select(*columns)
    totals = tech_rel_df
    if len(found) <= few:
        totals, touched = totals.where(F.col("technode1").isin(found)), F.col("technode1").isin(found)
        copied, old = top.where(~touched), top.where(touched)
    else:
        copied, old = (top.join(tags, "technode1", how) for how in ("left_anti", "left_semi"))
    fallen = delta.where("weight < 0").select("technode1").distinct()
    moved = totals.join(delta.select(*pair), pair, "left_semi").join(fallen, "technode1", "left_anti")
    still = old.join(delta.select(*pair), pair, "left_anti").join(fallen, "technode1", "left_anti")
    whole = totals.join(fallen, "technode1", "left_semi")
    ranked = top_neighbours(moved.select(*columns).unionByName(still.select(*columns))
                            .unionByName(whole.select(*columns)), k)
    return copied.select(*columns).unionByName(ranked.select(*columns))


def graph_edges(tech_rel_df: DataFrame, tech_node_df: DataFrame | None,
                k: int = EDGES_PER_TAG) -> DataFrame:
    """K4 + J3: pruned edges whose both endpoints are vertices, with names:
    ``technode1, technode2, name, weight, cnt``.

    J3 is two semi joins with the vertex keys (one row per tag, the
    vocabulary: broadcast when measured small). Pass ``tech_node_df=None``
    only when edges and vertices come from the same posts: a pair (a, b)
    exists only in a post with two different tags, which makes both a and b
    vertices, so the semi joins cannot remove a row there.
    """
    top = top_neighbours(tech_rel_df, k)
    if tech_node_df is not None:
        keys = tech_node_df.select(F.col("technode").alias("_v")).distinct()
        top = (top.join(keys, top.technode1 == keys._v, "left_semi")
               .join(keys, top.technode2 == keys._v, "left_semi"))
    return top.select("technode1", "technode2",
                      edge_name("technode1", "technode2").alias("name"), "weight", "cnt")


def user_vertices(user_tech_df: DataFrame) -> DataFrame:
    """K5: one user node per id, name and website ASCII only, '' for no site.
    Of several names of an id the least counts, as in ``user_tech_list``."""
    users = (user_tech_df.groupBy(F.col("user_id").alias("id"))
             .agg(F.min(F.struct("user_name", "user_website")).alias("user")))
    return users.select("id", ascii_only("user.user_name").alias("name"),
                        F.coalesce(ascii_only("user.user_website"), F.lit("")).alias("website"))


def contribute_edges(user_tech_df: DataFrame, tech_node_df: DataFrame) -> DataFrame:
    """K6 + J4: user -> tag edges whose tag is a vertex: ``user_id, tech, weight, cnt``.
    The tag name is written ASCII only (F8) and must then match a vertex name,
    so a tag with other characters has no edge unless its ASCII form is one.
    Of a user's tags with one ASCII form the first in byte order keeps the edge."""
    keys = tech_node_df.select(F.col("technode").alias("_v")).distinct()
    edges = (user_tech_df.groupBy("user_id", ascii_only("tech").alias("ascii"))
             .agg(F.min(F.struct("tech", "score", "cnt")).alias("first"))
             .select("user_id", F.col("ascii").alias("tech"),
                     F.col("first.score").alias("weight"), F.col("first.cnt").alias("cnt")))
    return edges.join(keys, edges.tech == keys._v, "left_semi")


def repair_user_names(users_df: DataFrame, name: str = "name",
                      website: str = "website") -> DataFrame:
    """P9 + F14 + D20 (+ F8): a name that is a printed tuple
    ``("bob","http://x",3)`` becomes name ``bob`` and website ``http://x``;
    others keep their website ('' when missing). Name and website are made
    ASCII only first, as they are written."""
    n, w = ascii_only(name), ascii_only(website)
    return users_df.select("id", repaired_name(n).alias("name"),
                           repaired_website(n, w).alias("website"))
