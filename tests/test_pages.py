"""Paging by rank over a stored order."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.sinks.pages import n_rows, page_by_rank, page_files, pages, write_paged


def table(spark, n=5000):
    """A third of the rows share their first key; nulls in it too."""
    a = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(n).select(a.alias("a"), (F.col("id") * 7919 % n).alias("b"), F.col("id").cast("string").alias("n_rows"))


@pytest.fixture()
def many_files(spark):
    """Small parts stay as they are, so that there are files to skip."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_all_pages_are_the_table_in_order(spark, scratch, many_files):
    df, order = table(spark), ["a", "b"]
    write_paged(df, f"{scratch}/t", order)
    found = [tuple(r) for page in pages(spark, f"{scratch}/t", order, 617) for r in page.collect()]
    assert found == [tuple(r) for r in df.orderBy(*order).collect()]
    assert n_rows(spark, f"{scratch}/t") == 5000
    page = page_by_rank(spark, f"{scratch}/t", order, 4321, 100)
    assert [tuple(r) for r in page.collect()] == [tuple(r) for r in df.orderBy(*order).offset(4321).limit(100).collect()]


def test_a_late_page_reads_no_more_files_than_the_first(spark, scratch, many_files):
    write_paged(table(spark), f"{scratch}/t", ["a", "b"])
    assert spark.read.parquet(f"{scratch}/t/index").count() == 8
    for offset in (0, 2500, 4950):
        named = page_files(spark, f"{scratch}/t", offset, 50)
        assert 1 <= len(named) <= 2
        page = page_by_rank(spark, f"{scratch}/t", ["a", "b"], offset, 50)
        assert len(page.inputFiles()) == len(named)


def test_ends_repeats_and_empty_tables(spark, scratch):
    df = table(spark, 40).unionAll(table(spark, 40))
    write_paged(df, f"{scratch}/t", ["a", "b"])
    assert rows(page_by_rank(spark, f"{scratch}/t", ["a", "b"], 80, 10)) == []
    assert page_by_rank(spark, f"{scratch}/t", ["a", "b"], 75, 10).count() == 5
    assert rows(page_by_rank(spark, f"{scratch}/t", ["a", "b"], 3, 0)) == []
    assert sum(p.count() for p in pages(spark, f"{scratch}/t", ["a", "b"], 9)) == 80
    write_paged(df.where("false"), f"{scratch}/e", ["a", "b"])
    assert rows(page_by_rank(spark, f"{scratch}/e", ["a", "b"], 0, 10)) == []
    assert list(pages(spark, f"{scratch}/e", ["a", "b"], 5)) == []
    with pytest.raises(ValueError):
        page_by_rank(spark, f"{scratch}/t", ["a", "b"], -1, 10)
