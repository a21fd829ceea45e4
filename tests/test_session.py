"""Session helpers: cluster sizing, the shared folder, plans per session."""

from conftest import SF001

from __spark_entry__ import queries
from tagloom.session import cluster_conf, ensure_checkpoint_dir


def test_cluster_conf_sizes_by_shuffle_volume():
    big = cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 40960      # 10 TB / 256 MB
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = cluster_conf(10 << 30, executors=4, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 32         # two waves of 16 cores
    capped = cluster_conf(10 << 50, executors=10, cores_per_executor=4)
    assert int(capped["spark.sql.shuffle.partitions"]) == 50_000


def test_checkpoint_dir_is_read_from_the_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_each_query_call_is_a_new_plan(spark):
    q = queries()["tech_rel"]
    a, b = q(spark, SF001), q(spark, SF001)
    assert a is not b and a._jdf is not b._jdf
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
