"""Totals over time kept by month and by year beside the days.

A range of days is covered by whole years, then whole months, then the days left at its ends:
at most 60 days, 22 months and the years between, each counted once. A rank over ten years
so reads some ninety rows a tag in place of 3,650, and the monthly trend reads one row a month.

``app_num`` adds up, so a batch's months and years are those of its days, merged like any total.
Results: an empty range (first day after the last) and an empty table give no rows; days of
null don't occur in ``tag_date`` (P5) and are left out here too.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .compare import RANK_SHOWN, top_ranks

DAY, MONTH, YEAR = "day", "month", "year"

Piece = tuple[str, dt.date, dt.date]    # level, first and last start of its nodes


def tag_rollup(tag_date_df: DataFrame) -> DataFrame:
    """``year, level, day, tech, app_num``: per tag the sums of each month and year, ``day`` their first day.

    The days are summed to months first; the second shuffle moves month sums only, each as its own
    node and as a part of its year's.
    """
    months = (tag_date_df.where(F.col("day").isNotNull())
              .groupBy("year", F.trunc("day", "month").alias("day"), "tech")
              .agg(F.sum("app_num").cast("bigint").alias("app_num")))
    node = F.array(F.struct(F.lit(MONTH).alias("level"), F.col("day").alias("day")),
                   F.struct(F.lit(YEAR).alias("level"), F.trunc("day", "year").alias("day")))
    return (months.select("year", "tech", "app_num", F.explode(node).alias("n"))
            .groupBy("year", F.col("n.level").alias("level"), F.col("n.day").alias("day"), "tech")
            .agg(F.sum("app_num").cast("bigint").alias("app_num")))


def months(rollup_df: DataFrame) -> DataFrame:
    """The month nodes in the form of ``tag_date``, as ``compare.monthly_trend`` reads it."""
    return rollup_df.where(F.col("level") == MONTH).drop("level")


def _next_month(day: dt.date) -> dt.date:
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)


def cover(first: dt.date, last: dt.date) -> list[Piece]:
    """The pieces that hold each day from ``first`` to ``last`` once, at most five of them."""
    one = dt.timedelta(days=1)
    month_from = first if first.day == 1 else _next_month(first)
    month_to = (last + one).replace(day=1)              # first month not whole
    if first > last:
        return []
    if month_from >= month_to:
        return [(DAY, first, last)]
    year_from = month_from if month_from.month == 1 else dt.date(month_from.year + 1, 1, 1)
    year_to = month_to.replace(month=1)                 # first year not whole
    if year_from >= year_to:
        inner = [(MONTH, month_from, month_to - one)]
    else:
        inner = [(MONTH, month_from, year_from - one), (YEAR, year_from, year_to - one), (MONTH, year_to, month_to - one)]
    pieces = [(DAY, first, month_from - one), *inner, (DAY, month_to, last)]
    return [p for p in pieces if p[1] <= p[2]]


def _within(pieces: list[Piece], level: bool) -> Column:
    """Rows of the pieces; the year, which the pieces imply, prunes the partitions."""
    tests = []
    for name, lo, hi in pieces:
        test = F.col("day").between(F.lit(lo), F.lit(hi)) & F.col("year").between(lo.year, hi.year)
        tests.append(test & (F.col("level") == name) if level else test)
    return reduce(or_, tests, F.lit(False))


def range_rows(tag_date_df: DataFrame, rollup_df: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """``tech, app_num`` rows whose sums per tag are those of the range, ends included."""
    pieces = cover(dt.date.fromisoformat(first_day), dt.date.fromisoformat(last_day))
    days = [p for p in pieces if p[0] == DAY]
    nodes = [p for p in pieces if p[0] != DAY]
    return (tag_date_df.where(_within(days, level=False)).select("tech", "app_num")
            .unionByName(rollup_df.where(_within(nodes, level=True)).select("tech", "app_num")))


def tech_rank_in_range(tag_date_df: DataFrame, rollup_df: DataFrame, first_day: str, last_day: str,
                       shown: int = RANK_SHOWN) -> DataFrame:
    """Q3 over the nodes of the range: the rows of ``compare.tech_rank_in_range``."""
    return top_ranks(range_rows(tag_date_df, rollup_df, first_day, last_day), shown)
