"""Month and year nodes beside the days."""

import datetime as dt
import random

from conftest import SF001, rows
from pyspark.sql import functions as F

from tagloom.operators import compare as cmp
from tagloom.operators import rollup as r
from tagloom.plans.tables import TagTables
from tagloom.sinks.writers import write_tables
from tagloom.sources.fixtures import load_sources

ONE = dt.timedelta(days=1)


def days_of(level, first, last):
    """The days of the nodes of one level whose first days lie from ``first`` to ``last``."""
    at = first
    while at <= last:
        if level == r.DAY or (at.day == 1 and (level == r.MONTH or at.month == 1)):
            end = at + ONE
            if level == r.MONTH:
                end = (at + 31 * ONE).replace(day=1)
            if level == r.YEAR:
                end = at.replace(year=at.year + 1)
            while at < end:
                yield at
                at += ONE
        else:
            at += ONE


def test_cover_holds_each_day_once():
    pick = random.Random(5)
    base = dt.date(1991, 1, 1)
    ranges = [sorted((pick.randrange(4000), pick.randrange(4000))) for _ in range(400)]
    ranges += [(0, 0), (0, 30), (0, 364), (0, 365), (1, 364), (364, 365), (31, 58), (1094, 1155), (3, 2)]
    for a, z in ranges:
        pieces = r.cover(base + a * ONE, base + z * ONE)
        found = [day for piece in pieces for day in days_of(*piece)]
        assert sorted(found) == [base + k * ONE for k in range(a, z + 1)], (a, z, pieces)
        assert len(pieces) <= 5
        assert sum((hi - lo).days + 1 for level, lo, hi in pieces if level == r.DAY) <= 60
        assert sum((hi.year - lo.year) * 12 + hi.month - lo.month + 1 for level, lo, hi in pieces if level == r.MONTH) <= 22


def test_ranges_equal_the_sums_of_days(spark, scratch):
    """200 random ranges in one plan, and some through the ranked query over written tables."""
    tables = TagTables(load_sources(spark, SF001))
    paths = write_tables({"tag_date": tables.tag_date, "tag_rollup": tables.tag_rollup}, scratch)
    days, nodes = (spark.read.parquet(paths[name]) for name in ("tag_date", "tag_rollup"))
    first, last = days.agg(F.min("day"), F.max("day")).first()
    span, pick = (last - first).days, random.Random(7)
    ranges = [sorted((pick.randrange(-40, span + 40), pick.randrange(-40, span + 40))) for _ in range(200)]
    ranges = [(k, first + a * ONE, first + z * ONE) for k, (a, z) in enumerate(ranges)]
    pieces = [(k, *piece) for k, a, z in ranges for piece in r.cover(a, z)]
    asked = spark.createDataFrame(pieces, "k int, level string, lo date, hi date")
    there = days.select(F.lit(r.DAY).alias("level"), "day", "tech", "app_num").unionByName(nodes.drop("year"))
    got = (there.join(F.broadcast(asked), ["level"]).where("day between lo and hi")
           .groupBy("k", "tech").agg(F.sum("app_num").alias("value")))
    plain = spark.createDataFrame(ranges, "k int, lo date, hi date")
    want = (days.join(F.broadcast(plain), F.col("day").between(F.col("lo"), F.col("hi")))
            .groupBy("k", "tech").agg(F.sum("app_num").alias("value")))
    assert rows(got, "k", "tech", "value") == rows(want, "k", "tech", "value")
    for _, a, z in ranges[:6]:
        ranked = r.tech_rank_in_range(days, nodes, a.isoformat(), z.isoformat(), 25)
        assert rows(ranked) == rows(cmp.tech_rank_in_range(days, a.isoformat(), z.isoformat(), 25))
    assert rows(r.tech_rank_in_range(days, nodes, "1995-05-05", "1995-05-04")) == []


def test_a_long_range_reads_few_rows_and_folders(spark, scratch):
    at = F.explode(F.sequence(F.lit(dt.date(1990, 1, 1)), F.lit(dt.date(1999, 12, 31))))
    days = (spark.range(3).select(F.col("id").cast("string").alias("tech"), at.alias("day"), F.lit(1).cast("bigint").alias("app_num"))
            .select(F.year("day").alias("year"), "day", "tech", "app_num"))
    paths = write_tables({"tag_date": days, "tag_rollup": r.tag_rollup(days)}, scratch)
    stored, nodes = (spark.read.parquet(paths[name]) for name in ("tag_date", "tag_rollup"))
    got = r.range_rows(stored, nodes, "1990-02-10", "1999-11-20")
    assert got.count() <= 3 * (60 + 22 + 8)
    assert got.agg(F.sum("app_num")).first()[0] == 3 * ((dt.date(1999, 11, 20) - dt.date(1990, 2, 10)).days + 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "year" in plan.split("PartitionFilters: [")[1][:200]
    files = {f.split("year=")[1][:4] for f in stored.where(r._within(
        [p for p in r.cover(dt.date(1990, 2, 10), dt.date(1999, 11, 20)) if p[0] == r.DAY], level=False))
        .select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {"1990", "1999"}


def test_trend_from_month_nodes_and_empty_days(spark):
    days = TagTables(load_sources(spark, SF001)).tag_date
    names = ("red-plate", "small-widget", "hot-ring")
    assert rows(cmp.monthly_trend(r.months(r.tag_rollup(days)), *names)) == rows(cmp.monthly_trend(days, *names))
    none = days.where("false")
    assert rows(r.tag_rollup(none)) == []
    assert rows(r.tech_rank_in_range(none, r.tag_rollup(none), "1990-01-01", "1999-01-01")) == []
    more = days.withColumn("level", F.lit("x")).unionByName(days.limit(1).withColumn("day", F.lit(None).cast("date")).withColumn("level", F.lit("y")))
    assert rows(r.tag_rollup(more)) == rows(r.tag_rollup(days))
