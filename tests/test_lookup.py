"""Probes from footers, fetches by bloom filters."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.sources.lookup import MOST_KEYS, V1_SOURCES, fetch_keys, id_bounds, read_footers, write_keyed


def scan_rows(df):
    """Rows that the scan gave to the filter, after the query ran."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_probe_is_answered_by_footers(spark, scratch):
    spark.range(5, 9000).repartition(5).write.parquet(f"{scratch}/t")
    before = spark.conf.get(V1_SOURCES)
    probe = id_bounds(read_footers(spark, f"{scratch}/t"))
    assert "PushedAggregation: [MIN(id), MAX(id), COUNT(*)]" in \
        probe._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert rows(probe) == [(5, 8999, 8995)]
    assert spark.conf.get(V1_SOURCES) == before


def test_probe_of_an_empty_table_and_null_ids(spark, scratch):
    spark.range(0).write.parquet(f"{scratch}/e")
    assert id_bounds(read_footers(spark, f"{scratch}/e")).collect()[0] == (None, None, 0)
    ids = spark.range(9).select(F.when(F.col("id") > 3, F.col("id")).alias("id"))
    ids.coalesce(1).write.parquet(f"{scratch}/n")
    assert rows(id_bounds(read_footers(spark, f"{scratch}/n"))) == [(4, 8, 9)]
    # a file of nulls only: an error from footers, not from a scan
    ids.repartitionByRange(9, "id").write.parquet(f"{scratch}/m")
    with pytest.raises(Exception):
        id_bounds(read_footers(spark, f"{scratch}/m")).collect()
    assert rows(id_bounds(spark.read.parquet(f"{scratch}/m"))) == [(4, 8, 9)]


def test_ten_scattered_keys_skip_row_groups(spark, scratch):
    """Forty files, each with ids over the whole range: minima and maxima rule nothing out, the filters do."""
    ids = spark.range(80_000).select((F.col("id") * 2).alias("id"), F.col("id").cast("string").alias("tags"))
    write_keyed(ids.repartition(40, "id"), f"{scratch}/t", "id", rows_per_group=2000)
    keys = [2 * 7919 * k for k in range(1, 6)] + [2 * 7919 * k + 1 for k in range(1, 6)]
    got = fetch_keys(spark.read.parquet(f"{scratch}/t"), "id", keys)
    assert sorted(r.id for r in got.collect()) == keys[:5]
    # five keys are there: their five groups, and at most a few by a filter's error
    assert 0 < scan_rows(got) <= 80_000 / 5


def test_all_ways_give_the_same_rows(spark, scratch):
    table = spark.range(3000).select((F.col("id") % 1500).alias("id"), F.col("id").alias("v"))
    write_keyed(table, f"{scratch}/t", "id", rows_per_group=500)
    there = spark.read.parquet(f"{scratch}/t")
    for keys in ([], [None], [3, 3, None, 99_999], list(range(25)), list(range(MOST_KEYS + 7))):
        want = rows(table.where(F.col("id").isin([k for k in keys if k is not None])))
        assert rows(fetch_keys(there, "id", keys)) == want
        as_table = spark.createDataFrame([(k,) for k in keys], "key long")
        assert rows(fetch_keys(there, "id", as_table)) == want
