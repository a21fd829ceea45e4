"""MinHash near-dedup: universal hash minima, banding, verification, components.

A document's set holds its distinct 5-word shingles as 64-bit hashes (words
are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a shorter document's whole
word sequence is one shingle). The steps:

1. One map pass gives each document its set size, a 128-bit fingerprint of the
   set, ``ROWS * BANDS`` universal hash minima (their low 16 bits are kept) and a
   key for each band.
2. Documents with one fingerprint are one class; its smallest id stands for it.
   Copies are never expanded into pairs.
3. Classes that share a band key are candidates. In every band bucket each
   class is held against one pivot, first the smallest and then the largest
   member. Members that are then still in different components are compared in
   blocks of a bucket by set size and by agreement of the minima's low halves.
   Only a spanning forest of the agreeing pairs comes out of a block pair; the
   forests' components are clusters, in which all agreeing pairs are looked at.
4. Every link is confirmed on both full shingle sets, taken from the whole
   texts: 100 * intersection >= 75 * union. A pivot's members are spread over
   salted partitions, each streaming past the pivot's set; a cluster's members
   are confirmed in pairs of blocks, each giving a spanning forest of its links.
5. Components by alternating large-star and small-star.

At a similarity of exactly 0.75 a pair shares no band with probability
(1 - 0.75**5)**40 = 2e-5. The minima filter passes pairs whose agreement is at
least 0.75 less 4 standard deviations.

Defined results: null, empty or wordless texts have an empty set and link with
nothing; repeated rows with one id are one document, of several texts the one
with the smallest hash, whatever the order of rows; rows without an id are
ignored; an empty table gives an empty table; only doc_id and text are read,
so other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, arrow_map, one_row
from tagloom.llm.components import components
from tagloom.llm.wordhash import NOT_SPACE, document_words, mix, slices

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 5, 40
#: Members of a band bucket, and of a cluster of texts, that one block holds, about.
BLOCK, TEXT_BLOCK = 512, 256
#: Members of one pivot that share a partition, about; hubs are spread over SALTS partitions.
SALTS = 64
SEED = 20240917

_SKETCH = "doc_id long, tie long, n_shingles long, print1 long, print2 long, minima binary, keys array<long>"


@lru_cache(maxsize=1)
def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = ROWS * BANDS
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's word hashes."""
    n = len(words)
    if not n:
        return words
    width = min(SHINGLE, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(0x9FB21C651E98DF25) + words[k : n - width + 1 + k])
    return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    a, b = _family()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        least = np.minimum(least, (a[:, None] * x[None, at : at + 2048] + b[:, None]).min(axis=1))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + column)
    return key.view(np.int64)


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    words, offsets = document_words(batch.column("text"), NOT_SPACE)
    for k in range(batch.num_rows):
        yield shingle_set(words[offsets[k] : offsets[k + 1]])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sizes, prints, least, keys = [], [], [], []
            for shingles in _sets(batch):
                sizes.append(len(shingles))
                if len(shingles):
                    prints.append(np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64))
                    own = minima(shingles)
                    least.append(own.astype(np.uint16).tobytes())
                    keys.append(band_keys(own))
                else:
                    prints.append((None, None))
                    least.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("tie"),
                    pa.array(sizes, pa.int64()),
                    pa.array([p[0] for p in prints], pa.int64()),
                    pa.array([p[1] for p in prints], pa.int64()),
                    pa.array(least, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "tie", "n_shingles", "print1", "print2", "minima", "keys"],
            )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a pivot and its members; rows come sorted by (pivot, salt), the pivot's own first."""
    pivot, base = None, np.empty(0, np.uint64)
    for whole in batches:
        for batch in slices(whole, "text"):
            a, b = [], []
            for p, own, doc, shingles in zip(
                batch.column("pivot").to_pylist(),
                batch.column("is_pivot").to_pylist(),
                batch.column("doc_id").to_pylist(),
                _sets(batch),
                strict=True,
            ):
                if own:
                    pivot, base = p, shingles
                    continue
                if p != pivot:
                    raise ValueError(f"the set of pivot {p} is missing")
                both = len(np.intersect1d(base, shingles, assume_unique=True))
                if 100 * both >= PERCENT * (len(base) + len(shingles) - both):
                    a.append(p)
                    b.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. ``texts`` has one row per doc_id."""
    salted = pairs.select(F.col("a").alias("pivot"), F.col("b").alias("doc_id")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    )
    # a pivot gets as many salts as its members need, at 256 members each
    heads = salted.groupBy("pivot").agg(F.least(F.lit(SALTS), F.ceil(F.count(F.lit(1)) / 256)).cast("int").alias("salts"))
    members = salted.join(heads, "pivot").select("pivot", "doc_id", (F.col("salt") % F.col("salts")).alias("salt"))
    own = heads.select("pivot", F.col("pivot").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = members.withColumn("is_pivot", F.lit(False)).unionByName(own.withColumn("is_pivot", F.lit(True)))
    return (
        rows.join(texts, "doc_id")
        .repartition("pivot", "salt")
        .sortWithinPartitions("pivot", "salt", F.desc("is_pivot"))
        .select("pivot", "is_pivot", "doc_id", "text")
        .transform(arrow_map, _verified, "a long, b long")
    )


def _best_pivot(pairs: DataFrame) -> DataFrame:
    """For each b the a that it shares most buckets with (of equals the smallest)."""
    return (
        pairs.groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("b")
        .agg(F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("best"))
        .select((-F.col("best.a")).alias("a"), "b")
    )


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    ends = pairs
    for end in ("a", "b"):
        own = label.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
        ends = ends.join(own, end, "left")
    return ends.where("coalesce(c_a, a) <> coalesce(c_b, b)").select("a", "b")


def _agreeing_pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs of one block pair, of different components, whose minima agree as a similar pair's do."""
    own, rep, n, label = (rows.column(c).to_numpy() for c in ("own", "rep", "n", "component"))
    bi, bj = (rows.column(c)[0].as_py() for c in ("bi", "bj"))
    left, right = np.flatnonzero(own == bi), np.flatnonzero(own == bj)
    apart = label[left, None] != label[None, right]
    fits = (n[left, None] * 100 >= n[None, right] * PERCENT) & (n[None, right] * 100 >= n[left, None] * PERCENT)
    once = rep[left, None] < rep[None, right] if bi == bj else True
    i, j = np.nonzero(apart & fits & once)
    i, j = left[i], right[j]
    low = np.frombuffer(b"".join(rows.column("low").to_pylist()), np.uint16).reshape(len(rep), -1)
    total = ROWS * BANDS
    least = int(np.floor((PERCENT / 100 - 4 * np.sqrt(0.75 * 0.25 / total)) * total))
    keep = [
        (low[i[at : at + 20_000]] == low[j[at : at + 20_000]]).sum(axis=1) >= least for at in range(0, len(i), 20_000)
    ]
    keep = np.concatenate(keep) if keep else np.empty(0, bool)
    return i[keep], j[keep]


def _forest(n: int, pairs: Iterator[tuple[int, int]], linked=None) -> Iterator[tuple[int, int]]:
    """A spanning forest of those pairs for which ``linked`` holds; pairs already joined aren't asked."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b and (linked is None or linked(i, j)):
            parent[b] = a
            yield i, j


def _agreeing_forest(rows: pa.Table) -> list[tuple[int, int]]:
    i, j = _agreeing_pairs(rows)
    return list(_forest(len(rows), zip(i.tolist(), j.tolist(), strict=True)))


def _linked_forest(rows: pa.Table) -> list[tuple[int, int]]:
    i, j = _agreeing_pairs(rows)
    if not len(i):
        return []
    sets = list(_sets(rows.select(["text"]).combine_chunks().to_batches()[0]))

    def linked(x: int, y: int) -> bool:
        both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return 100 * both >= PERCENT * (len(sets[x]) + len(sets[y]) - both)

    return list(_forest(len(rows), zip(i.tolist(), j.tolist(), strict=True), linked))


def _in_blocks(forest):
    """Forest edges of each block pair; rows come sorted by (group, bi, bj), so its rows are together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for whole in batches:
            for batch in slices(whole, "text") if "text" in whole.schema.names else [whole]:
                rows = pa.Table.from_batches([batch])
                rows = rows if kept is None else pa.concat_tables([kept, rows]).combine_chunks()
                new = np.zeros(len(rows), bool)
                for c in ("group", "bi", "bj"):
                    column = rows.column(c).to_numpy()
                    new[1:] |= column[1:] != column[:-1]
                edges = np.concatenate([[0], np.flatnonzero(new)])
                yield _edges(forest, [rows.slice(x, y - x) for x, y in zip(edges[:-1], edges[1:], strict=True)])
                kept = rows.slice(edges[-1])
        if kept is not None and len(kept):
            yield _edges(forest, [kept])

    return run


def _edges(forest, groups: list[pa.Table]) -> pa.RecordBatch:
    a, b = [], []
    for g in groups:
        if len(g) > 1:
            rep = g.column("rep").to_pylist()
            for i, j in forest(g):
                a.append(rep[i])
                b.append(rep[j])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _block_pairs(members: DataFrame, block: int) -> DataFrame:
    """Members (group, rep, component, ...) once for each block pair of their group that they take part in.

    A group of m members is cut into m / block blocks by a hash; each pair of
    blocks is a unit of work with a bounded number of rows, wherever it lands.
    Groups whose members are all in one component already are left out.
    """
    mixed = (
        members.groupBy("group")
        .agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(F.lit(1)).alias("m"))
        .where("c1 <> c2")
        .select("group", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    )
    return (
        members.join(mixed, "group")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("bi", F.least("own", "other"))
        .withColumn("bj", F.greatest("own", "other"))
        .drop("other", "blocks")
    )


def _left_over(buckets: DataFrame, label: DataFrame, sketch: DataFrame, texts: DataFrame, staged: Staged) -> DataFrame:
    """Links (a, b) enough to join what the pivots have left apart."""
    low = sketch.where("minima is not null").select(F.col("doc_id").alias("rep"), F.col("minima").alias("low"))

    def run(units: DataFrame, forest) -> DataFrame:
        dealt = units.repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj")
        return dealt.transform(arrow_map, _in_blocks(forest), "a long, b long")

    placed = buckets.join(label, F.col("rep") == F.col("node"), "left").select(
        F.col("key").alias("group"), "rep", "n", F.coalesce("component", "rep").alias("component")
    )
    agreeing = run(_block_pairs(placed, BLOCK).join(low, "rep"), _agreeing_forest)
    clusters = components(staged.write(agreeing.distinct(), "agreeing"), staged, "clusters")
    size = buckets.select("rep", "n").distinct()
    placed = (
        clusters.select(F.col("component").alias("group"), F.col("node").alias("rep"))
        .join(size, "rep")
        .join(label, F.col("rep") == F.col("node"), "left")
        .select("group", "rep", "n", F.coalesce("component", "rep").alias("component"))
    )
    units = _block_pairs(placed, TEXT_BLOCK).join(low, "rep").join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    return run(units, _linked_forest)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each document."""
    spark = docs.sparkSession
    staged = Staged(spark, "minhash")
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    sketch = staged.write(texts.transform(arrow_map, _sketches, _SKETCH), "sketch")
    if sketch.groupBy("doc_id").count().where("count > 1").limit(1).count():
        sketch = staged.write(one_row(sketch, "doc_id", "tie", "n_shingles", "print1", "print2"), "sketch-of-ids")
    full = sketch.where("n_shingles > 0")
    classes = full.groupBy("print1", "print2").agg(F.min("doc_id").alias("rep"))
    reps = staged.write(
        full.join(classes, ["print1", "print2"])
        .where(F.col("doc_id") == F.col("rep"))
        .select("rep", F.col("n_shingles").alias("n"), F.explode("keys").alias("key")),
        "bands",
    )
    shared = reps.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    buckets = staged.write(reps.join(shared, "key"), "buckets")
    staged.drop("bands")
    near = sketch.select("doc_id", "tie").join(buckets.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    candidates = texts.join(near, ["doc_id", "tie"], "left_semi").select("doc_id", "text")
    candidates = staged.write(candidates.dropDuplicates(["doc_id"]), "texts")

    edges = staged.write(confirm(_best_pivot(buckets.where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))), candidates), "edges-1")
    label = staged.write(components(edges, staged, "cc-1"), "label-1")
    second = _apart(buckets.where("rep <> high").select(F.col("high").alias("a"), F.col("rep").alias("b")), label)
    edges = staged.write(edges.union(confirm(_best_pivot(second), candidates)), "edges-2")
    label = staged.write(components(edges, staged, "cc-2"), "label-2")
    rest = _left_over(buckets.select("key", "rep", "n"), label, sketch, candidates, staged)
    edges = staged.write(edges.union(rest), "edges-3")
    staged.drop("texts", "buckets", "edges-1", "edges-2")
    label = staged.write(components(edges, staged, "cc-3"), "label-3")
    member = (
        sketch.join(classes, ["print1", "print2"], "left")
        .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
        .join(label, F.col("rep") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    )
    return member.withColumn("kept", F.col("doc_id") == F.col("component_id"))
