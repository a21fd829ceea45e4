"""The job entry points (python -m tagloom / spark-submit)."""

from conftest import SF001, raw_named

from tagloom.sources.fixtures import load_sources


def test_job_entry_points(spark, scratch, capsys):
    """build / incremental / page as a job would run them."""
    from tagloom.__main__ import main
    src = load_sources(spark, SF001)
    raw = raw_named(src)
    for kind, df in raw.items():
        df.write.parquet(f"{scratch}/{kind}")
    files = ["--posts", f"{scratch}/posts", "--comments", f"{scratch}/comments",
             "--users", f"{scratch}/users"]
    assert main(["build", *files, "--out", f"{scratch}/tables"], spark) == 0
    assert main(["incremental", *files, "--out", f"{scratch}/store",
                 "--posts-per-batch", "600", "--comments-per-batch", "6000"], spark) == 0
    assert main(["page", "--tables", f"{scratch}/tables",
                 "red-plate", "small-widget", "hot-ring"], spark) == 0
    out = capsys.readouterr().out
    assert "graph_edges\t" in out and "batches applied\t6" in out and "== monthly_trend" in out
    assert spark.read.parquet(f"{scratch}/tables/graph_edges").count() == 1550


def test_incremental_job_into_a_database(spark, scratch, capsys):
    import uuid

    from tagloom.__main__ import main
    from tagloom.streaming.incremental import JdbcTotalsStore
    src = load_sources(spark, SF001)
    for kind, df in raw_named(src).items():
        df.write.parquet(f"{scratch}/{kind}")
    url = f"jdbc:derby:memory:job{uuid.uuid4().hex[:8]};create=true"
    args = ["incremental", "--posts", f"{scratch}/posts", "--comments", f"{scratch}/comments",
            "--users", f"{scratch}/users", "--jdbc-url", url,
            "--jdbc-driver", "org.apache.derby.jdbc.EmbeddedDriver",
            "--posts-per-batch", "800", "--comments-per-batch", "9000"]
    assert main(args, spark) == 0
    assert main(args, spark) == 0
    out = capsys.readouterr().out
    assert "batches applied\t4" in out and "batches applied\t0" in out
    store = JdbcTotalsStore(spark, url, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert store.table("tech_node").count() == 62


def _sections(out):
    """The printed page of the last command."""
    return out[out.index("== compare_edge"):]


def test_store_to_graph_to_page(spark, scratch, capsys):
    """incremental, graph and page in a row: the same graph tables and page as the one-shot build."""
    from conftest import rows

    from tagloom.__main__ import main
    for kind, df in raw_named(load_sources(spark, SF001)).items():
        df.write.parquet(f"{scratch}/{kind}")
    files = ["--posts", f"{scratch}/posts", "--comments", f"{scratch}/comments",
             "--users", f"{scratch}/users"]
    tags = ["red-plate", "small-widget", "hot-ring"]
    assert main(["build", *files, "--out", f"{scratch}/tables"], spark) == 0
    assert main(["page", "--tables", f"{scratch}/tables", *tags], spark) == 0
    want = _sections(capsys.readouterr().out)
    assert main(["incremental", *files, "--out", f"{scratch}/store",
                 "--posts-per-batch", "800", "--comments-per-batch", "9000"], spark) == 0
    assert main(["graph", "--store", f"{scratch}/store", "--out", f"{scratch}/graph"], spark) == 0
    assert main(["page", "--store", f"{scratch}/store", "--tables", f"{scratch}/graph", *tags], spark) == 0
    assert _sections(capsys.readouterr().out) == want
    for name in ("graph_vertices", "graph_edges", "user_vertices", "contribute_edges"):
        assert rows(spark.read.parquet(f"{scratch}/graph/{name}")) == \
            rows(spark.read.parquet(f"{scratch}/tables/{name}"))


def test_jobs_from_a_source_database_to_a_database_store(spark, scratch):
    """Sources and totals both in (in-process) databases; the graph equals that of the files' totals."""
    import uuid

    from conftest import rows

    from tagloom.__main__ import main
    from tagloom.plans.tables import TagTables
    from tagloom.sinks.writers import write_jdbc
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    source, store = (f"jdbc:derby:memory:{k}{uuid.uuid4().hex[:8]};create=true" for k in ("src", "tot"))
    src = load_sources(spark, SF001)
    for kind, df in raw_named(src).items():
        write_jdbc(df, source, kind.upper(), mode="overwrite", properties={"driver": driver})
    given = ["--jdbc-url", store, "--jdbc-driver", driver]
    assert main(["incremental", "--posts", "POSTS", "--comments", "COMMENTS", "--users", "USERS",
                 "--source-url", source, "--source-driver", driver, *given,
                 "--posts-per-batch", "800", "--comments-per-batch", "9000"], spark) == 0
    assert main(["graph", *given, "--out", f"{scratch}/graph"], spark) == 0
    want = TagTables(src)
    for name in ("graph_edges", "contribute_edges"):
        assert rows(spark.read.parquet(f"{scratch}/graph/{name}")) == rows(getattr(want, name))


def test_graph_of_an_empty_store(spark, scratch):
    import pytest

    from tagloom.plans.jobs import run_graph
    from tagloom.streaming.incremental import TotalsStore
    with pytest.raises(ValueError, match="no batch of posts"):
        run_graph(TotalsStore(spark, f"{scratch}/none"), f"{scratch}/graph")


def test_stored_tables_are_clustered_by_their_lookup_column(spark, scratch):
    """Each file of a written table holds a run of tags of its own, in order; a
    lookup's filter reaches the scan."""
    import glob

    import pyarrow.parquet as pq

    from tagloom.plans.tables import TagTables
    from tagloom.sinks.writers import write_tables
    tables = TagTables(load_sources(spark, SF001))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = write_tables({"tech_rel": tables.tech_rel, "user_tech": tables.user_tech}, f"{scratch}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name, column in (("tech_rel", "technode1"), ("user_tech", "tech")):
        runs = []
        for file in glob.glob(f"{paths[name]}/*.parquet"):
            values = pq.read_table(file, columns=[column])[column].to_pylist()
            assert values == sorted(values)
            runs.append((values[0], values[-1]))
        runs.sort()
        assert len(runs) > 1 and all(a[1] <= b[0] for a, b in zip(runs, runs[1:]))
        assert sum(low <= "red-plate" <= high for low, high in runs) < len(runs)
        plan = spark.read.parquet(paths[name]).where(f"{column} = 'red-plate'")
        assert f"EqualTo({column},red-plate)" in plan._jdf.queryExecution().executedPlan().toString()


def test_incremental_into_runs_then_graph(spark, scratch, capsys):
    """--runs: the graph and page commands find the runs by themselves; a repeat merges nothing."""
    from conftest import rows

    from tagloom.__main__ import main
    from tagloom.plans.tables import TagTables
    src = load_sources(spark, SF001)
    for kind, df in raw_named(src).items():
        df.write.parquet(f"{scratch}/{kind}")
    args = ["incremental", "--posts", f"{scratch}/posts", "--comments", f"{scratch}/comments",
            "--users", f"{scratch}/users", "--out", f"{scratch}/store", "--runs"]
    assert main([*args, "--posts-per-batch", "800"], spark) == 0
    assert main(args[:-1], spark) == 0
    assert "batches applied\t3\nbatches applied\t0" in capsys.readouterr().out
    assert main(["graph", "--store", f"{scratch}/store", "--out", f"{scratch}/graph"], spark) == 0
    want = TagTables(src)
    for name in ("graph_edges", "contribute_edges"):
        assert rows(spark.read.parquet(f"{scratch}/graph/{name}")) == rows(getattr(want, name))
