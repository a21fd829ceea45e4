"""Graph tables (T1, J3, J4, K3-K6, F14) and the comparison queries (R1-R5,
Q1-Q4) on small inline tables."""

import datetime as dt

from conftest import rows

from tagloom.operators import compare as cmp
from tagloom.operators import graph as g

REL = "technode1 string, technode2 string, weight bigint, cnt bigint"
NODE = "technode string, weight bigint, cnt bigint"
UT = ("user_id bigint, user_name string, user_website string, tech string, score bigint, "
      "cnt bigint")


def test_top_neighbours_ties_and_limit(spark):
    data = [("a", f"n{i:02d}", 100 - i // 2, 1) for i in range(30)] + [("b", "a", 1, 1)]
    rel = spark.createDataFrame(data, REL)
    top = g.top_neighbours(rel, 25)
    got = rows(top.where("technode1 = 'a'"), "technode2")
    assert len(got) == 25 and got[-1] == ("n24",)          # ties broken by target
    assert top.where("technode1 = 'b'").count() == 1


def test_graph_edges_need_both_vertices(spark):
    rel = spark.createDataFrame([("a", "b", 5, 1), ("a", "z", 9, 1), ("b", "a", 5, 1)], REL)
    node = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], NODE)
    got = rows(g.graph_edges(rel, node), "technode1", "technode2", "name")
    assert got == [("a", "b", "a-b"), ("b", "a", "b-a")]


def test_user_vertices_and_contribute_edges(spark):
    ut = spark.createDataFrame([(1, "bøb", None, "a", 3, 1), (1, "bøb", None, "x", 1, 1),
                                (2, "ann", "http://w", "a", 2, 2)], UT)
    assert rows(g.user_vertices(ut)) == [(1, "bb", ""), (2, "ann", "http://w")]
    node = spark.createDataFrame([("a", 1, 1), ("cafe", 1, 1), ("café", 1, 1)], NODE)
    assert rows(g.contribute_edges(ut, node)) == [(1, "a", 3, 1), (2, "a", 2, 2)]
    ut2 = spark.createDataFrame([(3, "u", None, "café", 1, 1)], UT)
    # written as "caf", which is no vertex name: no edge (F8 + J4)
    assert g.contribute_edges(ut2, node).count() == 0


def test_repair_spoilt_names(spark):
    users = spark.createDataFrame(
        [(1, '("bob","http://x",3)', None), (2, "plain", None), (3, "odd (name)", "http://s"),
         (4, "ann", "http://a"), (5, '("zoë","http://z",1)', None)],
        "id bigint, name string, website string")
    got = rows(g.repair_user_names(users))
    assert got == [(1, "bob", "http://x"), (2, "plain", ""), (3, "odd name", ""),
                   (4, "ann", "http://a"), (5, "zo", "http://z")]    # D20 for id 3


def _tag_date(spark, items):
    return spark.createDataFrame(
        [(d.year, d, t, n) for d, t, n in items], "year int, day date, tech string, app_num bigint")


def test_monthly_trend_zero_fill_and_last_month_dropped(spark):
    td = _tag_date(spark, [
        (dt.date(2010, 1, 5), "x", 3), (dt.date(2010, 1, 9), "x", 1), (dt.date(2010, 1, 9), "y", 2),
        (dt.date(2010, 3, 1), "z", 4), (dt.date(2010, 4, 1), "x", 7),
        (dt.date(2010, 2, 1), "other", 9)])
    got = rows(cmp.monthly_trend(td, "x", "y", "z"), "date", "tech", "tech1", "tech2")
    assert got == [("2010-1", 4, 2, 0), ("2010-3", 0, 0, 4)]
    kept = rows(cmp.monthly_trend(td, "x", "y", "z", drop_last=False), "date")
    assert kept == [("2010-1",), ("2010-3",), ("2010-4",)]
    ext = cmp.trend_extents(cmp.monthly_trend(td, "x", "y", "z")).first()
    assert tuple(ext) == (dt.date(2010, 1, 1), dt.date(2010, 3, 1), 4)


def test_compare_edge_and_long(spark):
    rel = spark.createDataFrame([("a", "b", 5, 2), ("a", "c", 7, 3), ("b", "a", 5, 2)], REL)
    node = spark.createDataFrame([("a", 10, 4), ("b", 6, 3), ("c", 8, 3)], NODE)
    assert rows(cmp.compare_edge(rel, node, "a", ["b", "c"])) == [
        ("a", "b", 5, 2, 10, 4, 6, 3), ("a", "c", 7, 3, 10, 4, 8, 3)]
    assert rows(cmp.compare_edge_long(rel, "a", ["b", "c"])) == [
        ("with b", "count", 2), ("with b", "weight", 5), ("with c", "count", 3),
        ("with c", "weight", 7)]


def test_common_contributors_fewer_rows(spark):
    ut = spark.createDataFrame([(1, "u1", None, "a", 5, 1), (1, "u1", None, "b", 2, 1),
                                (2, "u2", "w", "b", 9, 1), (3, "u3", None, "a", 1, 1),
                                (3, "u3", None, "b", 2, 4)], UT)
    got = rows(cmp.common_contributors(ut, "a", "b"))
    # fewer than 4 shared users: what exists is returned
    assert got == [(1, "u1", "", 2, 1), (3, "u3", "", 2, 4)]
    ordered = [tuple(r) for r in cmp.common_contributors(ut, "a", "b").collect()]
    assert ordered[0][0] == 1                                # tie on score: first tag's score


def test_related_graph(spark):
    edges = spark.createDataFrame(
        [("n1", "a", "n1-a", 5, 1), ("n1", "b", "n1-b", 7, 1), ("n2", "a", "n2-a", 9, 1),
         ("n2", "b", "n2-b", 7, 1), ("n3", "a", "n3-a", 1, 1)],
        "technode1 string, technode2 string, name string, weight bigint, cnt bigint")
    assert [tuple(r) for r in cmp.related_techs(edges, "a", "b").collect()] == [
        ("n2", "n2-a", 9, "n2-b", 7), ("n1", "n1-a", 5, "n1-b", 7)]
    assert rows(cmp.related_graph_nodes(edges, "a", "b")) == [(0, "a"), (1, "b"), (2, "n2"),
                                                              (3, "n1")]
    assert rows(cmp.related_graph_edges(edges, "a", "b")) == [
        (2, 0, "n2-a"), (2, 1, "n2-b"), (3, 0, "n1-a"), (3, 1, "n1-b")]


def test_rank_in_range_and_top_users(spark):
    td = _tag_date(spark, [(dt.date(1996, 1, 1), "x", 3), (dt.date(1996, 12, 31), "y", 3),
                           (dt.date(1997, 1, 1), "z", 99), (dt.date(1996, 6, 1), "w", 1)])
    got = [tuple(r) for r in cmp.tech_rank_in_range(td, "1996-01-01", "1996-12-31").collect()]
    assert got == [("x", 3, 1), ("y", 3, 2), ("w", 1, 3)]
    ut = spark.createDataFrame([(i, f"u{i}", None, "a", i % 4, 1) for i in range(20)], UT)
    top = [tuple(r) for r in cmp.top_users_for_tech(ut, "a").collect()]
    assert len(top) == 10 and top[-1] == (3, "u3", "", 3, 1)      # drawn ascending (T5)
    assert [r[3] for r in top] == sorted(r[3] for r in top)


def test_pair_lookup_reads_unpruned_edges(spark):
    """A pair cut from the top-25 graph still answers the pair lookup,
    while the neighbour queries see only the pruned edges."""
    data = [("a", f"n{i:02d}", 100 - i, 1) for i in range(30)] + [("a", "z", 1, 1)]
    rel = spark.createDataFrame(data, REL)
    node = spark.createDataFrame([("a", 1, 1), ("z", 1, 1)] +
                                 [(f"n{i:02d}", 1, 1) for i in range(30)], NODE)
    edges = g.graph_edges(rel, node)
    assert edges.where("technode2 = 'z'").count() == 0
    assert rows(cmp.compare_edge(rel, node, "a", ["z"]), "technode2", "weight") == [("z", 1)]
    assert cmp.neighbourhood(edges, node, "a").where("name = 'z'").count() == 0


def test_year_partitioned_write_keeps_every_row(spark, scratch):
    """Every (day, tag) row lands in its year partition, none is lost."""
    from tagloom.sinks.writers import read_year_table, write_table
    td = _tag_date(spark, [(dt.date(2008 + i % 4, 1 + i % 12, 1 + i % 27), f"t{i % 7}", i)
                           for i in range(200)])
    td = td.groupBy("year", "day", "tech").agg({"app_num": "sum"}) \
        .withColumnRenamed("sum(app_num)", "app_num")
    write_table(td, f"{scratch}/date", partition_by=("year",))
    back = read_year_table(spark, f"{scratch}/date")
    assert rows(back, "year", "day", "tech", "app_num") == rows(td, "year", "day", "tech", "app_num")
    assert read_year_table(spark, f"{scratch}/date", [2009]).count() == \
        td.where("year = 2009").count()


def test_compare_edge_needs_both_vertices(spark):
    rel = spark.createDataFrame([("a", "b", 5, 2), ("a", "c", 7, 3)], REL)
    node = spark.createDataFrame([("a", 10, 4), ("b", 6, 3)], NODE)       # no vertex c
    assert rows(cmp.compare_edge(rel, node, "a", ["b", "c"])) == [("a", "b", 5, 2, 10, 4, 6, 3)]


def test_page_rows_are_not_capped(spark):
    """More rows than the page shows by itself, when asked for; months in order."""
    from tagloom.operators import compare as cmp
    people = [(k, f"u{k}", None, tech, k, 1) for k in range(20) for tech in ("a", "b")]
    ut = spark.createDataFrame(people, "user_id bigint, user_name string, user_website string, "
                                       "tech string, score bigint, cnt bigint")
    assert cmp.common_contributors(ut, "a", "b", shown=15).count() == 15
    days = spark.sql("select year(d) as year, d as day, 'a' as tech, 1L as app_num from "
                     "(select explode(sequence(date'2001-01-15', date'2004-12-15', interval 1 month)) as d)")
    trend = cmp.monthly_trend(days, "a", "b", "c").collect()
    assert len(trend) == 47 and trend == sorted(trend, key=lambda r: (r.year, r.month))


def test_refreshed_neighbours_equal_a_rebuild(spark):
    """Random batches with ties and, in some, weights that fall; a few tags or a join, by turns."""
    import random

    from tagloom.operators.graph import refresh_neighbours, top_neighbours
    from tagloom.operators.merge import SPECS, merge_totals
    rng, columns = random.Random(3), "technode1 string, technode2 string, weight long, cnt long"
    totals, top = {}, spark.createDataFrame([], columns)
    for step in range(7):
        tags = rng.sample(range(14), 14 if step == 0 else 3)
        batch = {(f"t{a}", f"t{b}"): rng.randint(-3 if step in (3, 5) else 0, 4)
                 for a in tags for b in rng.sample(range(14), 9) if a != b}
        delta = spark.createDataFrame([(a, b, w, 1) for (a, b), w in batch.items()], columns)
        before = spark.createDataFrame([(a, b, w, c) for (a, b), (w, c) in totals.items()], columns)
        now = merge_totals(before, delta, SPECS["tech_rel"])
        for (a, b), w in batch.items():
            old = totals.get((a, b), (0, 0))
            totals[a, b] = (old[0] + w, old[1] + 1)
        want = sorted(tuple(r) for r in top_neighbours(now, 4).collect())
        got = [tuple(r) for r in refresh_neighbours(top, now, delta, 4, few=50 if step % 2 else 2).collect()]
        assert sorted(got) == want, step
        top = spark.createDataFrame(want, columns)
    assert sorted(map(tuple, refresh_neighbours(top, now, delta.limit(0), 4).collect())) == want


def test_refresh_reads_only_touched_tags(spark, scratch):
    from tagloom.operators.graph import refresh_neighbours, top_neighbours
    columns = "technode1 string, technode2 string, weight long, cnt long"
    spark.range(20_000).selectExpr("concat('t', id div 100) technode1", "concat('t', id % 100) technode2",
                                   "id weight", "id cnt").write.parquet(f"{scratch}/rel")
    rel = spark.read.parquet(f"{scratch}/rel")
    delta = spark.createDataFrame([("t5", "t7", 0, 0)], columns)
    got = refresh_neighbours(top_neighbours(rel), rel, delta)
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(technode1,t5)" in physical
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, top_neighbours(rel).collect()))
