"""Quality by importance resampling: hashed n-gram models and Gumbel top-k.

Words and pairs of neighbouring words are hashed into ``BUCKETS``. Two
generative models are the smoothed bucket frequencies of the target (all
documents that ``labels`` marks with quality 1) and of the raw corpus (all
documents). A document's log weight is the sum over its n-grams of the log
ratio of the two; adding Gumbel noise drawn from a hash of its id and taking
the k largest samples k documents without replacement in proportion to their
weights. k is ``SHARE`` of the documents.

Counts are summed within each task before they are shuffled: a task gives at
most one row per bucket and model. The driver gets the bucket table, whose
size doesn't depend on the corpus, and for the k-th largest value a histogram
of fixed size that is refined until its bin is small.

Texts are not shuffled to find the target ones. Two hashed positions of each
target id are set in a sieve of at most ``SIEVE_BITS`` bits, which each task
holds its rows against; what passes is joined with the target ids themselves,
so the target is exact however full the sieve gets. The join is of one kind at
every size.

Defined results: null, empty and wordless texts have log weight 0; documents
with equal values at the threshold are all selected; repeated rows with one
id get one noise; rows without an id are not selected; without target
documents every log weight is 0; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, arrow_map
from tagloom.llm.wordhash import ALNUM, document_words, mix, slices

BUCKETS = 1 << 14
SHARE = 0.3
SMOOTHING = 1.0
BINS = 4096
SEED = 5
#: 8 MB; below that, 16 bits an id.
SIEVE_BITS = 1 << 26


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document number and bucket of each word and each pair of neighbours."""
    words, offsets = document_words(column, ALNUM)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pair = mix(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:])
    inside = doc[1:] == doc[:-1]
    buckets = np.concatenate([words, pair[inside]]) % np.uint64(BUCKETS)
    return np.concatenate([doc, doc[:-1][inside]]), buckets.astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for whole in batches:
        for batch in slices(whole, "text"):
            total += np.bincount(ngrams(batch.column("text"))[1], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def model(texts: DataFrame) -> np.ndarray:
    """Log frequency of each bucket over all rows of ``texts``."""
    rows = texts.select("text").transform(arrow_map, _counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.full(BUCKETS, SMOOTHING)
    for r in rows:
        total[r.bucket] += r.n
    return np.log(total / total.sum())


def _positions(bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(bits)) for k in (1, 2)]


def _sieve(ids: DataFrame) -> tuple[np.ndarray, int]:
    """Words of 64 bits with the positions of all ids set, and the number of bits."""
    bits = min(SIEVE_BITS, 1 << max(10, (16 * ids.count()).bit_length()))
    rows = (
        ids.select(F.explode(F.array(*_positions(bits))).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        .toArrow()
    )
    sieve = np.zeros(bits >> 6, np.uint64)
    sieve[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint64)
    return sieve, bits


def likely(docs: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """doc_id and the string ``columns`` of the rows of ``docs`` whose id is in ``ids``, and of a few others."""
    sieve, bits = _sieve(ids)
    shared = docs.sparkSession.sparkContext.broadcast(sieve)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for name in ("p1", "p2"):
                at = batch.column(name).to_numpy()
                keep &= (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.select(["doc_id", *columns]).filter(pa.array(keep))

    p1, p2 = _positions(bits)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
        .where("doc_id is not null")
        .select("doc_id", *columns, p1.alias("p1"), p2.alias("p2"))
        .transform(arrow_map, passing, ", ".join(["doc_id long", *(f"{c} string" for c in columns)]))
    )


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the rows of ``docs`` whose id is in ``ids``, which holds each id once."""
    return likely(docs, ids, "text").join(ids.hint("merge"), "doc_id", "left_semi")


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, by histograms of ``BINS`` bins over ever smaller ranges."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    above = 0
    while high > low:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)).cast("int")
        rows = (
            values.where(F.col(column).between(low, high))
            .groupBy(place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for r in rows:
            if above + r.n >= k:
                if above + 1 == k:
                    return r.high
                if above + r.n == k:
                    return r.low
                if (r.low, r.high) == (low, high):
                    return low  # a range that floats can't divide further
                low, high = r.low, r.high
                break
            above += r.n
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, log_weight, gumbel_key and selected of each row of ``docs``."""
    spark = docs.sparkSession
    staged = Staged(spark, "resample")
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    raw = model(docs)
    target = model(texts_of(docs, good))
    ratio = spark.sparkContext.broadcast(target - raw if target.std() > 0 else np.zeros(BUCKETS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, bucket = ngrams(batch.column("text"))
                weight = np.bincount(doc, ratio.value[bucket], minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(weight)], names=["doc_id", "log_weight"]
                )

    chance = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + F.lit(0.5)) / float(1 << 52)
    scored = staged.write(
        docs.select("doc_id", "text")
        .transform(arrow_map, run, "doc_id long, log_weight double")
        .withColumn("gumbel_key", F.when(F.col("doc_id").isNotNull(), F.col("log_weight") - F.log(-F.log(chance)))),
        "scored",
    )
    known = scored.where("gumbel_key is not null")
    k = int(np.ceil(share * known.count()))
    least = kth_largest(known, "gumbel_key", k) if k else float("inf")
    return scored.withColumn("selected", F.coalesce(F.col("gumbel_key") >= least, F.lit(False)))
