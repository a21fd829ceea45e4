import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tagloom.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tagloom-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tagloom-test-", dir="/tmp")


def rows(df, *cols):
    """Sorted plain tuples of a DataFrame (optionally of some columns)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def make_posts(spark):
    """Posts from (id, tags, answer, comment, favorite, 'yyyy-mm-dd')."""
    import datetime as dt

    from tagloom.sources.fixtures import SCHEMAS

    def make(items):
        data = [(i, tags, a, c, f, dt.datetime.fromisoformat(d)) for i, tags, a, c, f, d in items]
        return spark.createDataFrame(data, SCHEMAS["posts"])
    return make


def raw_named(src):
    """The three source frames with the original column names."""
    from tagloom.sources.qa import RAW_COLUMNS
    out = {}
    for kind, df in (("posts", src.posts), ("comments", src.comments), ("users", src.users)):
        out[kind] = df.select(*[df[ours].alias(raw) for raw, ours in RAW_COLUMNS[kind].items()])
    return out
