"""Helpers shared by the training-data operators: tables, staging, folds."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a session without
    that setting (a local one, as in tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not hasattr(spark, "_llm_folder"):
        spark._llm_folder = tempfile.mkdtemp(prefix="llm-")
    return spark._llm_folder


class Staged:
    """Tables of one operator run, written under the shared folder.

    A written table cuts lineage: a lost executor re-reads it. ``drop``
    removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def lean(run: Callable) -> Callable:
    """A map function that gives its memory back when its task ends.

    A Python worker stays for later tasks; what its allocators keep would
    stand beside the JVM of a stage that runs no Python.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return mapped


#: Bytes of an Arrow batch. A batch stands in the JVM's direct memory and in the worker, once for each core.
BATCH_BYTES = 4 << 20


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df`` mapped by ``run`` in batches of about ``BATCH_BYTES``; workers give their memory back.

    Spark reads the batch size when the map runs, so a larger one set in the
    session is lowered there and stays so.
    """
    conf, size = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(size, None)
    if held is None or not held.rstrip("b").isdigit() or int(held.rstrip("b")) > BATCH_BYTES:
        conf.set(size, str(BATCH_BYTES))
    return df.mapInArrow(lean(run), schema)


def one_row(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each ``key``: of several, the least by the columns ``order``, whatever the order of rows.

    Only keys that repeat are grouped with their columns.
    """
    again = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    rest = [c for c in df.columns if c != key]
    least = F.min(F.struct(*order, *(c for c in rest if c not in order))).alias("_row")
    several = df.join(again, key, "left_semi").groupBy(key).agg(least).select(key, *(F.col(f"_row.{c}") for c in rest))
    return df.join(again, key, "left_anti").select(key, *rest).unionByName(several)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fixed train / held-out folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    A text of one byte per character takes the fast built-in; others are
    translated letter by letter, so that É stays É.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ranked(df: DataFrame, order: tuple[str, ...], staged: Staged, name: str, rank: str = "rank") -> DataFrame:
    """``df`` with the place of each row, from 0, in the order of the columns ``order`` (nulls first).

    A range shuffle sorts the rows and a written table keeps their places in
    their parts; the parts' row counts, one row for each written part, give
    where a part starts. No row order passes through one task.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged.write(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(rank, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_at", "_start")
    )
