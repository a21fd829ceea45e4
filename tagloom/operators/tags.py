"""Per-post tag operators: cleanup, token explode and ordered pair expansion.

A post's tags travel as one array inside its row, so expanding and counting
tokens is a narrow ``Generate`` with no shuffle. Pairs are quadratic in the
post's length, so every post is first dealt out as work units of at most
``UNIT_TOKENS`` left tokens (one unit for a normal post); a huge post becomes
many units on many tasks. All posts take this one path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.tags import clean_tag_text, post_weight, split_tags

UNIT_TOKENS = 512


def post_tags(posts: DataFrame) -> DataFrame:
    """P2 + F1..F5: posts with tags -> ``id, day, weight, techlist``."""
    return posts.where(F.col("tags").isNotNull()).select(
        "id",
        F.col("creation_date").cast("date").alias("day"),
        post_weight("answer_count", "comment_count", "favorite_count").alias("weight"),
        clean_tag_text("tags").alias("techlist"))


def posts_tagged(posts: DataFrame) -> DataFrame:
    """S1 + P2 + F4: the tagged posts with their raw tag text."""
    return posts.where(F.col("tags").isNotNull()).select(
        "id", "tags", F.col("creation_date").cast("date").alias("day"),
        post_weight("answer_count", "comment_count", "favorite_count").alias("weight"))


def tag_lists(post_tags_df: DataFrame) -> DataFrame:
    """the list text and its number of tokens (0 for an empty text, D15)."""
    return post_tags_df.select(
        "id", "day", "weight", "techlist",
        F.size(split_tags("techlist")).cast("int").alias("n_tags"))


def tag_tokens(post_tags_df: DataFrame) -> DataFrame:
    """One row per token (repeats kept, empty tokens dropped)."""
    return post_tags_df.select("id", "day", "weight",
                               F.explode(split_tags("techlist")).alias("tag"))


def _counted(tags: Column) -> Column:
    """The distinct tags of an array in byte order with their multiplicity,
    ``array<struct<tag, m>>``: the runs of the sorted array, so a list of n
    tokens costs a sort and not n comparisons per tag."""
    ordered = F.array_sort(tags)

    def run_starts(xs: Column) -> Column:
        at = F.when(F.size(xs) > 0, F.sequence(F.lit(0), F.size(xs) - 1))
        return F.filter(at, lambda i: (i == 0) | (F.get(xs, i) != F.get(xs, i - 1)))

    # the sorted array and its starts are bound once each, as one-element arrays
    def runs(xs: Column) -> Column:
        def to_structs(starts: Column) -> Column:
            return F.transform(starts, lambda s, j: F.struct(
                F.get(xs, s).alias("tag"),
                (F.coalesce(F.get(starts, j + 1), F.size(xs)) - s).cast("bigint").alias("m")))
        return F.get(F.transform(F.array(run_starts(xs)), to_structs), F.lit(0))

    return F.get(F.transform(F.array(ordered), runs), F.lit(0))


def _units(df: DataFrame, n: Column, unit_tokens: int) -> DataFrame:
    """``df`` (one row per post, with ``id``) as one row per work unit, dealt
    over the tasks: column ``unit`` counts from 0."""
    last = F.floor((n - 1) / F.lit(unit_tokens)).cast("int")
    # a fixed width: by their bytes, which are few, units would be put together again
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.where(n > 1).withColumn("unit", F.explode(F.sequence(F.lit(0), last)))
            .repartition(width, "id", "unit"))


def tag_pairs(post_tags_df: DataFrame, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """G1: ordered pairs of a post's tokens, both directions, equal values
    skipped, repeats kept: ``id, day, weight, tech1, tech2``."""
    posts = post_tags_df.select("id", "day", "weight", split_tags("techlist").alias("tags"))
    left = F.slice("tags", F.col("unit") * unit_tokens + 1, F.lit(unit_tokens))
    return (_units(posts, F.size("tags"), unit_tokens)
            .select("id", "day", "weight", "tags", F.explode(left).alias("tech1"))
            .select("id", "day", "weight", "tech1",
                    F.explode(F.filter("tags", lambda y: y != F.col("tech1"))).alias("tech2")))


def token_counts(post_tags_df: DataFrame) -> DataFrame:
    """Distinct tags of each post with their multiplicity:
    ``id, day, weight, n, tag, m`` (n = tokens in the post)."""
    tags = split_tags("techlist")
    return (post_tags_df.select("id", "day", "weight", F.size(tags).cast("bigint").alias("n"),
                                F.explode(_counted(tags)).alias("tm"))
            .select("id", "day", "weight", "n", "tm.tag", "tm.m"))


def half_pair_counts(post_tags_df: DataFrame, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """Rewrite W2 at post level: for distinct tags a < b of one post, the
    reference emits m_a*m_b rows (a, b) and as many (b, a). Returns
    ``tech1 < tech2, weight = post weight * m_a*m_b, cnt = m_a*m_b``.

    The counted tags are in order, so the partners of one are all that follow."""
    posts = post_tags_df.select("id", "weight", _counted(split_tags("techlist")).alias("tms"))
    first = F.col("unit") * unit_tokens
    places = F.sequence(first, F.least(first + unit_tokens, F.size("tms")) - 1)
    pairs = (_units(posts, F.size("tms"), unit_tokens)
             .select("weight", "tms", F.explode(places).alias("i"))
             .select("weight", F.get("tms", F.col("i")).alias("a"),
                     F.explode(F.slice("tms", F.col("i") + 2, F.size("tms"))).alias("b")))
    return pairs.select(F.col("a.tag").alias("tech1"), F.col("b.tag").alias("tech2"),
                        (F.col("weight") * F.col("a.m") * F.col("b.m")).alias("weight"),
                        (F.col("a.m") * F.col("b.m")).alias("cnt"))
