"""JDBC source and sink on embedded in-memory Derby (inside the JVM: no
server, no port)."""

import uuid

import pytest
from conftest import SF001, raw_named, rows

from tagloom.sinks.writers import write_jdbc
from tagloom.sources import jdbc
from tagloom.sources.fixtures import load_sources

PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture()
def url():
    return f"jdbc:derby:memory:tagloom{uuid.uuid4().hex[:8]};create=true"


def test_write_read_partitioned(spark, url):
    posts = load_sources(spark, SF001).posts.select("id", "tags")
    write_jdbc(posts, url, "POSTS", mode="overwrite", properties=PROPS, num_partitions=4)
    lo, hi = jdbc.id_bounds(spark, url, "POSTS", '"id"', PROPS)
    assert (lo, hi) == (0, 1499)
    back = jdbc.read_jdbc_partitioned(spark, url, "POSTS", "id", num_partitions=4,
                                      bounds=(lo, hi), properties=PROPS)
    assert back.rdd.getNumPartitions() == 4
    assert rows(back) == rows(posts)


def test_id_batch_over_jdbc(spark, url):
    posts = load_sources(spark, SF001).posts.select("id", "tags")
    write_jdbc(posts, url, "POSTS", mode="overwrite", properties=PROPS)
    batch = jdbc.read_id_batch(spark, url, "POSTS", "id", 500, 1000, num_partitions=3,
                               properties=PROPS)
    assert batch.count() == 500
    assert batch.agg({"id": "min"}).first()[0] == 500
    q = jdbc.read_jdbc(spark, url, query='SELECT "id" FROM POSTS WHERE "tags" IS NULL',
                       properties=PROPS)
    assert q.count() == 27


def test_totals_to_jdbc(spark, url):
    """K1 over JDBC: a stored table written in batches and read back whole."""
    from tagloom.plans.tables import TagTables
    tables = TagTables(load_sources(spark, SF001))
    node = tables.tech_node
    write_jdbc(node, url, "TECH_NODE", mode="overwrite", properties=PROPS,
               batch_rows=16, num_partitions=2)
    back = jdbc.read_jdbc(spark, url, table="TECH_NODE", properties=PROPS)
    assert rows(back) == rows(node)
    assert back.count() == 62


def test_sources_with_original_column_names(spark, scratch, url):
    """Tables with the original column names, from Parquet and over JDBC,
    give the same totals as the package's own views."""
    from tagloom.plans.tables import TagTables
    from tagloom.sources.qa import read_sources, read_sources_jdbc
    src = load_sources(spark, SF001)
    raw = raw_named(src)
    paths = {}
    for kind, df in raw.items():
        paths[kind] = f"{scratch}/{kind}"
        df.write.parquet(paths[kind])
        write_jdbc(df, url, kind.upper(), mode="overwrite", properties=PROPS)
    want = TagTables(src)
    for got in (read_sources(spark, paths),
                read_sources_jdbc(spark, url, {k: k.upper() for k in raw}, PROPS,
                                  num_partitions=3)):
        tables = TagTables(got)
        assert rows(tables.tech_rel) == rows(want.tech_rel)
        assert rows(tables.user_tech) == rows(want.user_tech)
        assert rows(tables.tag_list) == rows(want.tag_list)


def test_totals_store_in_a_database(spark, url):
    """A9 + D19 into database tables: id batches merged once each, a replay
    skipped, the result equal to the one-shot totals."""
    from tagloom.operators import tags as t
    from tagloom.operators import totals as tot
    from tagloom.sources import batches as b
    from tagloom.streaming.incremental import (JdbcTotalsStore, apply_comment_batch,
                                               apply_post_batch)
    src = load_sources(spark, SF001)
    store = JdbcTotalsStore(spark, url, PROPS)
    for low, high in b.batch_bounds(0, 1499, 600):
        assert apply_post_batch(store, b.id_batch(src.posts, low, high), f"posts-{low}")
    assert not apply_post_batch(store, b.id_batch(src.posts, 0, 600), "posts-0")
    for low, high in b.batch_bounds(0, 15_000, 8_000):
        assert apply_comment_batch(store, b.id_batch(src.comments, low, high), src.posts,
                                   src.users, f"comments-{low}")
    pt = t.post_tags(src.posts)
    assert rows(store.table("tech_rel")) == rows(tot.tech_rel(pt))
    assert rows(store.table("tech_node")) == rows(tot.tech_node(pt))
    assert rows(store.table("tag_date")) == rows(tot.tag_date(pt))
    assert rows(store.table("tag_list", years=[1996])) == \
        rows(tot.tag_list(pt).where("year = 1996"))
    assert rows(store.table("user_tech")) == rows(tot.user_tech(pt, src.comments, src.users))
    assert store.versions()[("tech_rel", -1)] == 2
    # a second store object on the same database sees the same state
    again = JdbcTotalsStore(spark, url, PROPS)
    assert again.applied("posts-600") and not again.applied("posts-9")
    p = again.table("tag_date", years=[1997])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(year), *EqualTo(year,1997)]" in p
