"""Spark session settings and the shared working folder.

Everything here is plain Spark configuration. Cluster jobs get their session
from ``spark-submit``; ``local_session`` is only for tests, the bench and the
driver checks on one machine.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package relies on. AQE re-plans joins from
# runtime sizes (broadcast only what is measured small, split skewed shuffle
# partitions, coalesce tiny ones); the UI stays off (no web server).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # a join side is broadcast only when its size (file statistics, or the
    # measured shuffle output under AQE) is below this bound
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tagloom", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cpus]`` session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in {**SCALE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 shuffle_fraction: float = 0.1, max_width: int = 50_000) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    Only the projected, partially aggregated columns are shuffled, so the
    shuffle is taken as ``shuffle_fraction`` of the input. The initial shuffle
    width gives each reducer about 256 MB of it, at least two waves of the
    cluster's cores and at most ``max_width`` (the map x reduce block count
    stays manageable); AQE then coalesces small partitions to 128 MB and
    splits skewed ones. Scan splits are 256 MB, so 100 TB is about 400k tasks.
    """
    cores = max(1, executors * cores_per_executor)
    by_size = -(-int(input_bytes * shuffle_fraction) // (256 << 20))
    width = min(max_width, max(2 * cores, by_size))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }


def apply_scale_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options on an existing session (cluster jobs)."""
    for key, value in SCALE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    A cluster sets it to a shared file system; only when it is unset (tests on
    one machine) do we pick a fresh folder under ``/tmp``, once per session. No
    setting of the session is changed.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
        if path:
            return path
        path = os.path.join("/tmp", f"tagloom-ckpt-{uuid.uuid4().hex[:8]}")
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])
