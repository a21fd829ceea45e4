"""Merges (A9, A10), batches (S5, S6, D1) and the ledger store."""

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from tagloom.operators import merge as mg
from tagloom.operators import tags as t
from tagloom.operators import totals as tot
from tagloom.sources import batches as b
from tagloom.sources.fixtures import load_sources
from tagloom.streaming.incremental import (TotalsStore, apply_comment_batch, apply_post_batch,
                                           stream_posts)


@pytest.fixture(scope="module")
def src(spark):
    return load_sources(spark, SF001)


def test_boundary_ids_kept(spark):
    df = spark.range(99_998, 100_003)
    got = []
    for low, high in b.batch_bounds(0, 100_002, 100_000):
        got += [r.id for r in b.id_batch(df, low, high).collect()]
    assert sorted(got) == [99_998, 99_999, 100_000, 100_001, 100_002]     # D1


def test_batch_bounds_include_max():
    assert b.batch_bounds(0, 200_000, 100_000) == [(0, 100_000), (100_000, 200_000),
                                                   (200_000, 300_000)]


def test_with_batch_labels(spark):
    df = spark.createDataFrame([(0,), (2_999,), (3_000,), (9_000,)], "id bigint")
    got = rows(b.with_batch(df, 3000), "id", "batch", "batch_low", "loop", "slot")
    assert got == [(0, 0, 0, 0, 0), (2_999, 0, 0, 0, 0), (3_000, 1, 3000, 0, 1),
                   (9_000, 3, 9000, 1, 0)]


def test_three_batch_union(spark):
    df = spark.range(0, 10)
    parts = [b.id_batch(df, lo, lo + 3) for lo in (0, 3, 6)]
    assert rows(mg.union_batches(parts)) == [(i,) for i in range(9)]


def test_page(spark):
    df = spark.range(0, 100).select((99 - F.col("id")).alias("k"))
    assert rows(b.page(df, ["k"], 10, 5)) == [(10,), (11,), (12,), (13,), (14,)]


def test_merge_any_split_equals_one_shot(src):
    pt = t.post_tags(src.posts)
    whole = rows(tot.tech_rel(pt))
    for cut in (200, 777, 1200):
        old, new = pt.where(F.col("id") < cut), pt.where(F.col("id") >= cut)
        merged = mg.merge_totals(tot.tech_rel(old), tot.tech_rel(new), mg.SPECS["tech_rel"])
        assert rows(merged) == whole
        node = mg.merge_totals(tot.tech_node(old), tot.tech_node(new), mg.SPECS["tech_node"])
        assert rows(node) == rows(tot.tech_node(pt))


def test_user_merge_keeps_fields(spark):
    """Two partial aggregates of one (user, tag) give name, website, sums."""
    cols = "user_id bigint, user_name string, user_website string, tech string, " \
           "score bigint, cnt bigint"
    old = spark.createDataFrame([(7, "bob", "http://x", "a", 3, 1)], cols)
    new = spark.createDataFrame([(7, "bob2", "http://y", "a", 4, 2),
                                 (8, "ann", None, "a", 1, 1)], cols)
    got = rows(mg.merge_totals(old, new, mg.SPECS["user_tech"]))
    assert got == [(7, "bob", "http://x", "a", 7, 3), (8, "ann", None, "a", 1, 1)]


def test_insert_if_absent_first_wins(spark):
    cols = "technode1 string, technode2 string, weight bigint, cnt bigint"
    old = spark.createDataFrame([("a", "b", 1, 1)], cols)
    new = spark.createDataFrame([("a", "b", 9, 9), ("b", "a", 2, 2)], cols)
    got = rows(mg.insert_if_absent(old, new, ["technode1", "technode2"]))
    assert got == [("a", "b", 1, 1), ("b", "a", 2, 2)]


def test_store_batches_equal_one_shot_and_replay_is_noop(spark, src, scratch):
    store = TotalsStore(spark, f"{scratch}/store")
    pt_all = t.post_tags(src.posts)
    for low, high in b.batch_bounds(0, 1499, 500):
        assert apply_post_batch(store, b.id_batch(src.posts, low, high), f"posts-{low}")
    # replaying a batch changes nothing
    assert not apply_post_batch(store, b.id_batch(src.posts, 0, 500), "posts-0")
    assert rows(store.table("tech_rel")) == rows(tot.tech_rel(pt_all))
    assert rows(store.table("tech_node")) == rows(tot.tech_node(pt_all))
    assert rows(store.table("tag_date")) == rows(tot.tag_date(pt_all))
    assert rows(store.table("tag_list")) == rows(tot.tag_list(pt_all))
    assert store.versions()[("tech_rel", -1)] == 2


def test_store_user_batches(spark, src, scratch):
    store = TotalsStore(spark, f"{scratch}/users")
    for low, high in b.batch_bounds(0, 15_000, 5_000):
        apply_comment_batch(store, b.id_batch(src.comments, low, high), src.posts, src.users,
                            f"comments-{low}")
    want = tot.user_tech(t.post_tags(src.posts), src.comments, src.users)
    assert rows(store.table("user_tech")) == rows(want)


def test_stream_foreach_batch(spark, src, scratch):
    """Structured Streaming drives the same merge; a restart re-reading the
    checkpoint adds nothing."""
    source = f"{scratch}/posts_in"
    for low, high in b.batch_bounds(0, 1499, 750):
        b.id_batch(src.posts, low, high).coalesce(1).write.mode("append").parquet(source)
    store = TotalsStore(spark, f"{scratch}/store")
    q = stream_posts(spark, source, store, f"{scratch}/ckpt")
    q.awaitTermination(300)
    want = rows(tot.tech_rel(t.post_tags(src.posts)))
    assert rows(store.table("tech_rel")) == want
    q2 = stream_posts(spark, source, store, f"{scratch}/ckpt")
    q2.awaitTermination(300)
    assert rows(store.table("tech_rel")) == want


def test_build_job_and_page_from_written_tables(spark, src, scratch):
    from tagloom.plans.jobs import run_build, serve_compare
    from tagloom.plans.tables import TagTables, compare
    paths = run_build(spark, src, f"{scratch}/tables", stage_root=f"{scratch}/stage")
    assert set(paths) == set(TagTables.STORED)
    fresh = TagTables(src)
    for name, path in paths.items():
        want = getattr(fresh, name)
        assert rows(spark.read.parquet(path).select(*want.columns)) == rows(want), name
    served = serve_compare(spark, f"{scratch}/tables", "red-plate", "small-widget", "hot-ring")
    direct = compare(fresh, "red-plate", "small-widget", "hot-ring")
    for name in ("compare_edge", "monthly_trend", "common_contributors", "related_graph_edges"):
        assert rows(served[name]) == rows(direct[name]), name


def test_incremental_loop(spark, src, scratch):
    from tagloom.plans.jobs import run_incremental
    store = TotalsStore(spark, f"{scratch}/inc")
    n = run_incremental(spark, src, store, posts_per_batch=600, comments_per_batch=6000)
    assert n == 3 + 3
    assert run_incremental(spark, src, store, posts_per_batch=600, comments_per_batch=6000) == 0
    pt = t.post_tags(src.posts)
    assert rows(store.table("tag_list")) == rows(tot.tag_list(pt))
    assert rows(store.table("user_tech")) == rows(tot.user_tech(pt, src.comments, src.users))


def test_stream_comments(spark, src, scratch):
    from tagloom.streaming.incremental import stream_comments
    source = f"{scratch}/comments_in"
    for low, high in b.batch_bounds(0, 15_000, 4_000):
        b.id_batch(src.comments, low, high).coalesce(1).write.mode("append").parquet(source)
    store = TotalsStore(spark, f"{scratch}/store")
    q = stream_comments(spark, source, store, src.posts, src.users, f"{scratch}/ckpt")
    q.awaitTermination(300)
    want = tot.user_tech(t.post_tags(src.posts), src.comments, src.users)
    assert rows(store.table("user_tech")) == rows(want)
    assert store.ledger().select("batch_id").distinct().count() == 4


def test_store_rewrites_only_touched_years(spark, src, scratch):
    import os
    store = TotalsStore(spark, f"{scratch}/years")
    year = F.year("creation_date")
    early = src.posts.where(year <= 1996)
    late = src.posts.where(year == 1997)
    assert apply_post_batch(store, early, "early")
    assert apply_post_batch(store, late, "late")
    v = store.versions()
    assert v[("tag_date", 1995)] == 0 and v[("tag_date", 1996)] == 0
    assert v[("tag_date", 1997)] == 1
    written = [d for d in os.listdir(store.path("tag_date", 1)) if d.startswith("year=")]
    assert written == ["year=1997"]
    both = t.post_tags(early.unionByName(late))
    assert rows(store.table("tag_date")) == rows(tot.tag_date(both))
    assert rows(store.table("tag_list", years=[1997])) == \
        rows(tot.tag_list(both).where("year = 1997"))
    assert rows(store.table("tech_rel")) == rows(tot.tech_rel(both))


def test_crash_before_ledger_commit_is_retried_once(spark, src, scratch, monkeypatch):
    """A job that dies after writing its table versions but before the
    ledger append leaves only unreferenced folders; the retry overwrites them
    and the batch is counted once."""
    import tagloom.streaming.incremental as inc
    store = TotalsStore(spark, f"{scratch}/crash")
    first = b.id_batch(src.posts, 0, 700)
    second = b.id_batch(src.posts, 700, 1500)
    assert apply_post_batch(store, first, "b0")
    real = inc.TotalsStore.apply

    def dying_apply(self, batch_id, deltas):
        # write every table version, then fail before the commit
        for name, delta in deltas.items():
            spec = inc.SPECS[name]
            have = {p: v for (t_, p), v in self.versions().items() if t_ == name}
            nv = max(have.values(), default=-1) + 1
            inc.write_table(delta.select(*spec.columns), self.path(name, nv), "overwrite",
                            spec.partition_by, spec.keys)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(inc.TotalsStore, "apply", dying_apply)
    with pytest.raises(RuntimeError):
        apply_post_batch(store, second, "b1")
    monkeypatch.setattr(inc.TotalsStore, "apply", real)
    assert not store.applied("b1")
    assert rows(store.table("tech_rel")) == rows(tot.tech_rel(t.post_tags(first)))
    assert apply_post_batch(store, second, "b1")
    assert not apply_post_batch(store, second, "b1")
    assert rows(store.table("tech_rel")) == rows(tot.tech_rel(t.post_tags(src.posts)))
    assert rows(store.table("tag_list")) == rows(tot.tag_list(t.post_tags(src.posts)))


def test_incremental_goes_on_where_it_ended(spark, src, scratch):
    """The source grows three times under changing batch sizes: each time the
    store equals a build of all that is there, and a repeat adds nothing."""
    from tagloom.plans.jobs import run_incremental
    from tagloom.sources.fixtures import Sources
    store = TotalsStore(spark, f"{scratch}/grown")
    for top, size in ((300, 1000), (750, 200), (1500, 700)):
        now = Sources(src.posts.where(F.col("id") <= top),
                      src.comments.where(F.col("id") < top * 10), src.users)
        assert run_incremental(spark, now, store, size, 10 * size) > 0
        assert run_incremental(spark, now, store, size + 1, 10 * size) == 0
        pt = t.post_tags(now.posts)
        assert rows(store.table("tech_node")) == rows(tot.tech_node(pt))
        assert rows(store.table("tag_list")) == rows(tot.tag_list(pt))


def test_second_stream_is_counted(spark, src, scratch):
    """Two streams with their own checkpoints into one store."""
    store = TotalsStore(spark, f"{scratch}/store")
    for k, (low, high) in enumerate(((0, 700), (700, 1500))):
        source = f"{scratch}/in{k}"
        b.id_batch(src.posts, low, high).coalesce(1).write.parquet(source)
        stream_posts(spark, source, store, f"{scratch}/ckpt{k}").awaitTermination(300)
    assert rows(store.table("tech_node")) == rows(tot.tech_node(t.post_tags(src.posts)))


def test_batch_with_a_post_without_a_date(spark, scratch):
    from tagloom.sources.fixtures import SCHEMAS
    posts = spark.createDataFrame([(1, "<a><b>", 1, 0, 0, None)], SCHEMAS["posts"])
    dated = posts.withColumn("id", F.lit(2).cast("bigint")).withColumn(
        "creation_date", F.lit("2012-01-02").cast("timestamp_ntz"))
    store = TotalsStore(spark, f"{scratch}/dates")
    assert apply_post_batch(store, posts.unionByName(dated), "b0")
    assert rows(store.table("tech_node")) == [("a", 2, 2), ("b", 2, 2)]
    assert rows(store.table("tag_list"), "techlist", "app_num") == [("a b", 1)]


def test_unreadable_ledger_is_an_error(spark, src, scratch):
    import os
    store = TotalsStore(spark, f"{scratch}/broken")
    assert apply_post_batch(store, b.id_batch(src.posts, 0, 200), "b0")
    name = next(f for f in os.listdir(store.ledger_path) if f.endswith(".parquet"))
    with open(f"{store.ledger_path}/{name}", "wb") as f:
        f.write(b"not a table")
    with pytest.raises(Exception):
        store.versions()


def test_rebuild_leaves_no_old_year(spark, src, scratch):
    import os

    from tagloom.plans.jobs import run_build
    from tagloom.sources.fixtures import Sources
    run_build(spark, src, f"{scratch}/tables")
    fewer = Sources(src.posts.where(F.year("creation_date") <= 1995), src.comments, src.users)
    paths = run_build(spark, fewer, f"{scratch}/tables")
    assert rows(spark.read.parquet(paths["tag_date"]).select("year").distinct()) == \
        rows(tot.tag_date(t.post_tags(fewer.posts)).select("year").distinct())
    assert not [d for d in os.listdir(f"{scratch}/tables") if d.startswith("_stage")]


def test_user_edges_are_unique(spark):
    from tagloom.operators.graph import contribute_edges
    users = spark.createDataFrame([(1, "caf\u00e9", 5, 1), (1, "caf", 3, 2), (2, "caf\u00e9", 4, 1)],
                                  "user_id bigint, tech string, score bigint, cnt bigint")
    nodes = spark.createDataFrame([("caf",)], "technode string")
    assert rows(contribute_edges(users, nodes)) == [(1, "caf", 3, 2), (2, "caf", 4, 1)]


def test_renamed_user_stays_one(spark, scratch):
    """A user renamed between batches keeps the first name, on tags of later batches too:
    one list row and one vertex, in the store and in the merge alone."""
    from tagloom.operators import graph, totals
    from tagloom.streaming.incremental import TotalsStore

    columns = "user_id long, user_name string, user_website string, tech string, score long, cnt long"
    first = spark.createDataFrame([(1, "bob", "http://b", "a", 5, 1), (2, "ann", None, "a", 1, 1)], columns)
    second = spark.createDataFrame([(1, "bobby", None, "a", 2, 1), (1, "bobby", None, "b", 9, 1),
                                    (3, "zed", None, "b", 1, 1)], columns)
    third = spark.createDataFrame([(1, "robert", "x", "c", 1, 1), (3, "zeb", "y", "b", 1, 1)], columns)
    store = TotalsStore(spark, scratch)
    for k, batch in enumerate((first, second, third)):
        assert store.apply(f"b{k}", {"user_tech": batch})
    table = store.table("user_tech")
    assert sorted(tuple(r) for r in table.collect()) == [
        (1, "bob", "http://b", "a", 7, 2), (1, "bob", "http://b", "b", 9, 1), (1, "bob", "http://b", "c", 1, 1),
        (2, "ann", None, "a", 1, 1), (3, "zed", None, "b", 2, 2)]
    lists = {r.user_id: (r.user_name, [x.tech for x in r.techs]) for r in totals.user_tech_list(table).collect()}
    assert lists == {1: ("bob", ["b", "a", "c"]), 2: ("ann", ["a"]), 3: ("zed", ["b"])}
    assert sorted(tuple(r) for r in graph.user_vertices(table).collect()) == [
        (1, "bob", "http://b"), (2, "ann", ""), (3, "zed", "")]
    # rows that were never merged: still one row and one vertex per user, the same in any order
    for mixed in (first.union(second), second.union(first)):
        assert sorted((r.user_id, r.user_name) for r in totals.user_tech_list(mixed).collect()) == [
            (1, "bob"), (2, "ann"), (3, "zed")]
        assert graph.user_vertices(mixed).count() == 3
