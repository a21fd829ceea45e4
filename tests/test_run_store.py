"""Totals as runs: commits of several writers, compaction, late ids, windows by rows."""

import os
import random

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F

from tagloom.operators import tags as t
from tagloom.operators import totals as tot
from tagloom.plans.jobs import merge_source, run_incremental
from tagloom.sources.fixtures import Sources, load_sources
from tagloom.streaming import commit_log
from tagloom.streaming.coverage import MAX_INTERVALS, Conflict, add_interval, fits, plan, windows
from tagloom.streaming.incremental import post_batch_deltas
from tagloom.streaming.run_store import RunStore

USERS = "user_id long, user_name string, user_website string, tech string, score long, cnt long"


@pytest.fixture(scope="module")
def src(spark):
    return load_sources(spark, SF001)


def node(spark, *items):
    return spark.createDataFrame(list(items), "technode string, weight long, cnt long")


def node_totals(posts):
    return {"tech_node": tot.tech_node(t.post_tags(posts))}


def disk(folder):
    """Bytes of the runs' data files."""
    return {d: sum(os.path.getsize(os.path.join(at, f)) for at, _, fs in os.walk(f"{folder}/{d}")
                   for f in fs if f.endswith(".parquet")) for d in os.listdir(folder)}


def test_batches_equal_one_build_and_a_replay_adds_nothing(spark, src, scratch):
    store = RunStore(spark, f"{scratch}/s")
    assert run_incremental(spark, src, store, 375, 4000) == 4 + -(-src.comments.count() // 4000)
    assert run_incremental(spark, src, store, 300, 5000) == 0
    pt = t.post_tags(src.posts)
    for name in ("tech_rel", "tech_node", "tag_date", "tag_list"):
        assert rows(store.table(name)) == rows(getattr(tot, name)(pt)), name
    assert rows(store.table("user_tech")) == rows(tot.user_tech(pt, src.comments, src.users))
    assert rows(store.table("tag_date", years=[1996])) == rows(tot.tag_date(pt).where("year = 1996"))
    assert rows(store.table("posts_ids")) == rows(src.posts.select("id"))
    # four batches of each post table became one run; nothing staged is left
    assert len(store.log.state().runs["tech_rel"]) == 1
    assert os.listdir(f"{scratch}/s/_stage") == []


def test_bytes_written_follow_the_batch(spark, scratch):
    """A large table stays untouched while small batches come in, and through their compaction."""
    store = RunStore(spark, f"{scratch}/s", tier_bytes=20_000)
    big = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("technode"),
                                     F.lit(1).cast("long").alias("weight"), F.lit(1).cast("long").alias("cnt"))
    assert store.apply("big", {"tech_node": big})
    before = disk(f"{scratch}/s/tech_node")
    for k in range(6):
        assert store.apply(f"b{k}", {"tech_node": node(spark, ("a", 1, 1), (f"t{k}", 2, 1))})
        store.compact()
    after = disk(f"{scratch}/s/tech_node")
    written = sum(v for d, v in after.items() if d not in before)
    assert written < sum(before.values()) / 100
    assert set(before) <= {f"run={r}" for r in store.log.state().runs["tech_node"]}
    assert rows(store.table("tech_node").where("technode in ('a', 't3')")) == [("a", 6, 6), ("t3", 2, 1)]
    assert store.table("tech_node").count() == 60_007


def test_a_key_filter_reaches_the_runs(spark, scratch):
    store = RunStore(spark, f"{scratch}/s")
    for k in range(2):
        store.apply(f"b{k}", {"tech_node": node(spark, ("a", 1, 1), ("b", 1, 1))})
    plan_text = store.table("tech_node").where("technode = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(technode,a)" in plan_text


def test_two_writers_both_count_once(spark, scratch, monkeypatch):
    """B commits between A's read of the log and A's commit; then the same batch by both."""
    a, b = (RunStore(spark, f"{scratch}/s") for _ in range(2))
    real, between = commit_log.CommitLog.commit, []

    def late(self, state, entry):
        while between:
            between.pop()()
        return real(self, state, entry)

    monkeypatch.setattr(commit_log.CommitLog, "commit", late)
    between.append(lambda: b.apply("b", {"tech_node": node(spark, ("x", 2, 1), ("y", 3, 1))}))
    assert a.apply("a", {"tech_node": node(spark, ("x", 1, 1))})
    assert rows(a.table("tech_node")) == [("x", 3, 2), ("y", 3, 1)]
    between.append(lambda: b.apply("same", {"tech_node": node(spark, ("z", 5, 1))}))
    assert not a.apply("same", {"tech_node": node(spark, ("z", 5, 1))})
    assert rows(b.table("tech_node")) == [("x", 3, 2), ("y", 3, 1), ("z", 5, 1)]
    # the loser's files are gone
    assert len(os.listdir(f"{scratch}/s/tech_node")) == 3


def test_two_writers_of_overlapping_ids(spark, src, scratch, monkeypatch):
    """Another job merges part of a planned window first: the window is planned again."""
    a, b = (RunStore(spark, f"{scratch}/s") for _ in range(2))
    real, other = RunStore.merge_window, []

    def late(self, *args):
        while self is a and other:
            other.pop()()
        return real(self, *args)

    monkeypatch.setattr(RunStore, "merge_window", late)
    other.append(lambda: merge_source(b, "posts", src.posts.where("id < 700"), 350, node_totals))
    merge_source(a, "posts", src.posts, 500, node_totals)
    assert rows(a.table("tech_node")) == rows(tot.tech_node(t.post_tags(src.posts)))
    with pytest.raises(Conflict):
        a.apply("again", {"tech_node": node(spark, ("x", 1, 1))}, ("posts", [600, 900, 300, 5], None))
    assert not a.applied("again")


def test_a_killed_batch_or_compaction_is_harmless(spark, scratch, monkeypatch):
    store = RunStore(spark, f"{scratch}/s", fanout=2)
    store.apply("b0", {"tech_node": node(spark, ("a", 1, 1))})
    store.apply("b1", {"tech_node": node(spark, ("a", 2, 1))})
    reader = store.log.state()                        # a reader of the state before the compaction

    def killed(self, state, entry):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(commit_log.CommitLog, "commit", killed)
        with pytest.raises(RuntimeError):
            store.compact()
        with pytest.raises(RuntimeError):
            store.apply("b2", {"tech_node": node(spark, ("a", 4, 1))})
    assert rows(store.table("tech_node")) == [("a", 3, 2)]
    assert store.compact() == 1 and store.compact() == 0
    assert store.apply("b2", {"tech_node": node(spark, ("a", 4, 1))})
    assert rows(store.table("tech_node")) == [("a", 7, 3)]
    assert rows(store.table("tech_node", state=reader)) == [("a", 3, 2)]
    # in use for a while yet: nothing is deleted; later the two old runs and the two of the killed jobs
    assert store.vacuum() == []
    assert len(store.vacuum(keep_seconds=-60)) == 4
    assert rows(store.table("tech_node")) == [("a", 7, 3)]
    assert len(os.listdir(f"{scratch}/s/tech_node")) == 2
    assert store.log.state().retired == {}


def test_two_compactions_of_the_same_runs(spark, scratch, monkeypatch):
    a, b = (RunStore(spark, f"{scratch}/s", fanout=2) for _ in range(2))
    for k in range(2):
        a.apply(f"b{k}", {"tech_node": node(spark, ("a", 1, 1))})
    real, between = RunStore._write_run, [lambda: b.compact()]

    def late(self, *args):
        out = real(self, *args)
        while between:
            between.pop()()
        return out

    monkeypatch.setattr(RunStore, "_write_run", late)
    assert a.compact() == 0
    assert rows(a.table("tech_node")) == [("a", 2, 2)]


def test_first_name_stays_through_any_compaction(spark, scratch):
    """The first committed name of a user, though small runs are summed before a large early one."""
    store = RunStore(spark, f"{scratch}/s", fanout=2)
    names = ["bob", "bobby", "al", "robert"]
    for k, name in enumerate(names):
        store.apply(f"b{k}", {"user_tech": spark.createDataFrame(
            [(1, name, None, "a", 1, 1), (1, name, None, f"t{k}", 1, 1), (k + 2, name, f"w{k}", "a", 1, 1)], USERS)})
    want = sorted([(1, "bob", None, "a", 4, 4), *((1, "bob", None, f"t{k}", 1, 1) for k in range(4)),
                   *((k + 2, name, f"w{k}", "a", 1, 1) for k, name in enumerate(names))], key=str)
    assert sorted(rows_any(store.table("user_tech")), key=str) == want
    # compact all but the first run, then everything
    state = store.log.state()
    tail = dict(sorted(state.runs["user_tech"].items(), key=lambda r: r[1]["seq"])[1:])
    store._due = lambda s: ("user_tech", tail) if tail.keys() <= s.runs["user_tech"].keys() else None
    assert store.compact() == 1
    assert sorted(rows_any(store.table("user_tech")), key=str) == want
    del store._due
    assert store.compact() == 1
    assert sorted(rows_any(store.table("user_tech")), key=str) == want


def rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_log_states_and_markers(spark, scratch, monkeypatch):
    """A batch stays known when its entry is folded into a state and trimmed away."""
    monkeypatch.setattr(commit_log, "SNAPSHOT_EVERY", 3)
    store = RunStore(spark, f"{scratch}/s", fanout=3)
    for k in range(8):
        assert store.apply(f"b{k}", {"tech_node": node(spark, ("a", 1, 1))})
        store.compact()
    assert len(store.vacuum(keep_seconds=-60)) > 0
    names = os.listdir(f"{scratch}/s/_log")
    assert len([n for n in names if n.endswith(".state")]) == 1
    for k in range(8):
        assert not store.apply(f"b{k}", {"tech_node": node(spark, ("a", 1, 1))})
    assert rows(store.table("tech_node")) == [("a", 8, 8)]


def test_missing_commit_is_an_error(spark, scratch):
    store = RunStore(spark, f"{scratch}/s")
    for k in range(3):
        store.apply(f"b{k}", {"tech_node": node(spark, ("a", 1, 1))})
    store.files.delete("_log/000000000001.entry")
    with pytest.raises(RuntimeError, match="commit 1"):
        store.table("tech_node")


def test_ids_filled_in_below_the_cursor_are_merged_once(spark, src, scratch):
    """Rows arrive in random order over many runs; after each the totals equal those of what is there."""
    store, rng = RunStore(spark, f"{scratch}/s"), random.Random(7)
    for share in (0.3, 0.31, 0.8, 1.0):
        there = src.posts.where((F.xxhash64("id") % 1000 + 999) / 1998 <= share)
        merge_source(store, "posts", there, rng.choice([90, 300]), node_totals)
        assert rows(store.table("tech_node")) == rows(tot.tech_node(t.post_tags(there))), share
        assert merge_source(store, "posts", there, 200, node_totals) == 0


def test_sparse_ids_make_one_window(spark):
    ids = spark.range(1000).select((F.col("id") * 10**9).alias("id"))
    assert list(plan(ids, [], 1000)) == [(0, 999 * 10**9 + 1, None)]
    assert list(plan(spark.range(0), [], 10)) == []


def test_windows_are_about_equally_deep(spark, monkeypatch):
    """Half of the ids crowded in a corner; a small sketch makes windows be cut again."""
    from tagloom.streaming import coverage
    ids = spark.range(4000).select(F.when(F.col("id") < 2000, F.col("id")).otherwise(F.col("id") * 10**7).alias("id"))
    for parts in (1000, 5):
        monkeypatch.setattr(coverage, "PARTS", parts)
        got = list(windows(ids, 0, 3999 * 10**7 + 1, 4000, 100))
        assert got[0][0] == 0 and got[-1][1] == 3999 * 10**7 + 1
        assert all(a[1] == b[0] for a, b in zip(got, got[1:]))
        depth = [ids.where((F.col("id") >= a) & (F.col("id") < b)).count() for a, b in got]
        assert sum(depth) == 4000 and max(depth) <= 300 and len(got) >= 20


def test_intervals_stay_few_and_keep_their_counts():
    kept = []
    for k in range(500):
        kept = add_interval(kept, [10 * k, 10 * k + 9, 1 + k % 7, k])
    assert len(kept) == MAX_INTERVALS
    assert sum(r[2] for r in kept) == sum(1 + k % 7 for k in range(500))
    assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))
    kept = add_interval([[0, 10, 3, 6]], [0, 10, 2, 5])
    assert kept == [[0, 10, 5, 3]]
    assert fits(kept, 10, 20, None) and not fits(kept, 9, 20, None)
    assert fits(kept, 0, 10, [0, 10, 5, 3]) and not fits(kept, 0, 10, [0, 10, 4, 3])


def test_posts_without_id_and_empty_sources(spark, src, scratch):
    store = RunStore(spark, f"{scratch}/s")
    empty = Sources(src.posts.limit(0), src.comments.limit(0), src.users)
    assert run_incremental(spark, empty, store) == 0 and store.table("tech_rel") is None
    loose = src.posts.withColumn("id", F.when(F.col("id") >= 40, F.col("id")))
    assert merge_source(store, "posts", loose.where("id is null or id < 60"), 100, post_batch_deltas) == 1
    assert store.table("posts_ids").count() == 20
