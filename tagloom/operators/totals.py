"""Totals per tag, tag pair, (day, tag), (day, tag list) and (user, tag).

Every total is a ``groupBy`` with sum/count, so Spark runs a partial
(map-side) aggregate before the shuffle and a hot key costs one row per task,
not one row per occurrence.

Two hand rewrites keep the pair table out of the plans (SURVEY section 4):
W1 -- a tag with multiplicity m in a post of n tokens takes part in m*(n-m)
ordered pair rows, so tag and day totals come from per-post token counts;
W2 -- pair totals are symmetric, so only tech1 < tech2 is aggregated and the
result is mirrored after the shuffle. The ``*_from_pairs`` forms follow the
reference literally and are kept for the equality tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.tags import clean_list_text, split_tags
from .skew import Hot, salted_join
from .tags import UNIT_TOKENS, half_pair_counts, token_counts


def _mirror(half: DataFrame, a: str, b: str, rest: list[str]) -> DataFrame:
    """(a, b, ...) plus (b, a, ...), as a two-element explode after the
    aggregate: one pass over the aggregate, no second branch to plan or
    reuse. A filter on a node column stays above it; below it are only the
    aggregated pairs, at most one row per pair of tags per task."""
    both = F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")),
                   F.struct(F.col(b).alias("x"), F.col(a).alias("y")))
    return (half.select(F.explode(both).alias("_m"), *rest)
            .select(F.col("_m.x").alias(a), F.col("_m.y").alias(b), *rest))


def tech_rel(post_tags_df: DataFrame, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """A1 (TECH_REL): per ordered tag pair, sum of post weight and number of
    pair rows: ``technode1, technode2, weight, cnt``."""
    half = (half_pair_counts(post_tags_df, unit_tokens)
            .groupBy("tech1", "tech2")
            .agg(F.sum("weight").cast("bigint").alias("weight"),
                 F.sum("cnt").cast("bigint").alias("cnt"))
            .select(F.col("tech1").alias("technode1"), F.col("tech2").alias("technode2"),
                    "weight", "cnt"))
    return _mirror(half, "technode1", "technode2", ["weight", "cnt"])


def tech_node(post_tags_df: DataFrame) -> DataFrame:
    """A2 + A3 (TECH_NODE): per tag, the posts where it meets another tag
    (D4): sum of their weight and their number: ``technode, weight, cnt``."""
    tc = token_counts(post_tags_df)
    return (tc.where(F.col("m") < F.col("n"))
            .groupBy(F.col("tag").alias("technode"))
            .agg(F.sum("weight").cast("bigint").alias("weight"),
                 F.count(F.lit(1)).alias("cnt")))


def tag_date(post_tags_df: DataFrame, count: str = "pairs") -> DataFrame:
    """A4 (DATE_yyyy as one table with a ``year`` column).

    ``count="pairs"`` (the reference, D5): the number of ordered pair rows of
    the tag that day, i.e. sum of m*(n-m). ``count="posts"``: the number of
    posts with the tag that day.
    """
    # P5: a record without a day has no date row (the pair totals keep it)
    tc = token_counts(post_tags_df.where(F.col("day").isNotNull()))
    if count == "pairs":
        contrib = F.col("m") * (F.col("n") - F.col("m"))
        tc = tc.where(F.col("m") < F.col("n"))
    elif count == "posts":
        contrib = F.lit(1).cast("bigint")
    else:
        raise ValueError(f"count must be 'pairs' or 'posts', not {count!r}")
    return (tc.groupBy(F.year("day").alias("year"), "day", F.col("tag").alias("tech"))
            .agg(F.sum(contrib).cast("bigint").alias("app_num")))


def tag_list(post_tags_df: DataFrame) -> DataFrame:
    """A5 (DATE_yyyy_LIST): per (day, cleaned tag-list text), sum of weight and
    number of posts, single-tag posts included. The text is cleaned before
    grouping (D7). As in ``tag_date`` a post without a day has no row (P5)."""
    return (post_tags_df.where(F.col("day").isNotNull())
            .groupBy(F.year("day").alias("year"), "day",
                     clean_list_text("techlist").alias("techlist"))
            .agg(F.sum("weight").cast("bigint").alias("weight"),
                 F.count(F.lit(1)).alias("app_num")))


def clean_tag_lists(post_tags_df: DataFrame) -> DataFrame:
    """F8 per post."""
    return post_tags_df.select("id", clean_list_text("techlist").alias("techlist"))


# ---- literal forms over the pair table (reference semantics, for tests) ----

def tech_rel_from_pairs(pairs: DataFrame) -> DataFrame:
    return (pairs.groupBy(F.col("tech1").alias("technode1"), F.col("tech2").alias("technode2"))
            .agg(F.sum("weight").cast("bigint").alias("weight"), F.count(F.lit(1)).alias("cnt")))


def tech_node_from_pairs(pairs: DataFrame) -> DataFrame:
    per_post = pairs.dropDuplicates(["tech1", "id"])
    return (per_post.groupBy(F.col("tech1").alias("technode"))
            .agg(F.sum("weight").cast("bigint").alias("weight"), F.count(F.lit(1)).alias("cnt")))


def tag_date_from_pairs(pairs: DataFrame) -> DataFrame:
    return (pairs.groupBy(F.year("day").alias("year"), "day", F.col("tech1").alias("tech"))
            .agg(F.count(F.lit(1)).alias("app_num")))


# ---- comments and users ----

def comments_tagged(posts: DataFrame, comments: DataFrame, users: DataFrame) -> DataFrame:
    """J1 + J2 + P2 + P3: comments with their post's tags and their user."""
    c = comments.where(F.col("user_id").isNotNull())
    p = posts.where(F.col("tags").isNotNull()).select(F.col("id").alias("p_id"), "tags")
    u = users.select(F.col("id").alias("u_id"), F.col("display_name").alias("user_name"),
                     F.col("website_url").alias("user_website"))
    return (c.join(p, c.post_id == p.p_id).join(u, c.user_id == u.u_id)
            .select("id", "user_id", "user_name", "user_website", "tags", "score"))


def user_tag_scores(post_tags_df: DataFrame, comments: DataFrame, hot: Hot | None = None) -> DataFrame:
    """A6 without the user fields: per (user, tag) sum of comment score and
    number of (comment, token) rows.

    The comments are joined to the posts' token arrays (one shuffle of each
    side on the post id; AQE splits a hot post's partition), the array is
    exploded after the join, and the (user, tag) aggregate is partial before
    its shuffle. ``hot`` (``skew.heavy_keys`` of the comments' posts) deals the
    comments of hot posts out without AQE.
    """
    c = comments.where(F.col("user_id").isNotNull()).select(
        "post_id", "user_id", "score", *(["id"] if hot else []))
    toks = post_tags_df.select(F.col("id").alias("post_id"), split_tags("techlist").alias("tags"))
    return scores_of(salted_join(c, toks, "post_id", hot or [], "id"))


def scores_of(commented: DataFrame) -> DataFrame:
    """The (user, tag) sums of comments that have their post's ``tags`` beside them."""
    return (commented.select("user_id", "score", F.explode("tags").alias("tech"))
            .groupBy("user_id", "tech")
            .agg(F.sum("score").cast("bigint").alias("score"), F.count(F.lit(1)).alias("cnt")))


def with_users(scores: DataFrame, users: DataFrame) -> DataFrame:
    """J2 after the sums: one row per user and tag is joined, not one per comment."""
    u = users.select(F.col("id").alias("user_id"), F.col("display_name").alias("user_name"),
                     F.col("website_url").alias("user_website"))
    return scores.join(u, "user_id").select("user_id", "user_name", "user_website",
                                            "tech", "score", "cnt")


def user_tech(post_tags_df: DataFrame, comments: DataFrame, users: DataFrame,
              hot: Hot | None = None) -> DataFrame:
    """A6 (USER_TECH): ``user_id, user_name, user_website, tech, score, cnt``.

    The user fields are joined after the aggregate; AQE broadcasts the users
    side only when its measured size is under the broadcast threshold.
    """
    return with_users(user_tag_scores(post_tags_df, comments, hot), users)


def user_tech_list(user_tech_df: DataFrame) -> DataFrame:
    """One row per user id with ``techs``, the list of (tech, score, cnt) by
    score descending, then tech. A user's list holds at most one entry per
    distinct tag, so it is bounded by the tag vocabulary, not by the data.
    Totals give a user one name (the first, see ``merge_totals``); of rows
    with several the least name counts, so a user is never two."""
    item = F.struct(F.negative("score").alias("k"), "tech", "score", "cnt")
    return (user_tech_df.groupBy("user_id")
            .agg(F.sort_array(F.collect_list(item)).alias("items"),
                 F.min(F.struct("user_name", "user_website")).alias("user"))
            .select("user_id", "user.user_name", "user.user_website",
                    F.transform("items", lambda x: F.struct(x["tech"], x["score"], x["cnt"]))
                    .alias("techs")))


__all__ = [
    "tech_rel", "tech_node", "tag_date", "tag_list", "clean_tag_lists",
    "tech_rel_from_pairs", "tech_node_from_pairs", "tag_date_from_pairs",
    "comments_tagged", "user_tag_scores", "scores_of", "with_users", "user_tech", "user_tech_list",
]
