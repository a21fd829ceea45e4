"""Embedding near-dedup by sorted projection passes, with an exact completion.

Vectors with equal labels (and lengths) are compared by cosine in double
precision. Equal vectors of a label are one class; the smallest id stands for it,
so copies are never compared. The steps:

1. Unit vectors are centred at their label's mean. In each of ``PASSES`` passes
   the signs of ``BITS`` random projections, joined to one key, order the vectors of
   a label lexicographically (equal keys by a hash of pass and id, so that a dense
   group is mixed anew in each pass); one range shuffle of (pass, label, key) rows
   gives every vector its place in every pass.
2. A pass compares each vector with the ``WINDOW`` places after it, in blocks of
   places that reach that far into the next block. Links found are counted by
   the first pass that sees the pair.
3. The places of the first pass also cut a label into blocks, of which centre and
   radius are known. Block pairs whose members can't come near enough by the
   angle between the centres and the radii are left out; in the others a tiled matrix
   product finds what no pass has seen, so no link is lost in crowded labels.
4. Units of both kinds give link counts of their members and a spanning forest of
   their links, so a dense group moves no more rows than a sparse one. The
   forests of all passes and block pairs are joined to components.

``n_pass_links`` are the links that the passes found; its sum over that of the links
between different vectors is the recall of the passes alone. Units are bounded in
bytes whatever the dimension. The completion sends a class to each block of its
label that the bound can't rule out: ``SPREAD`` blocks, or as many as hold
``BLOCK_BYTES`` each.

Defined results: vectors that are null, empty or zero, that hold null or
non-finite components, or that have no label link with nothing, as do vectors
of different lengths; repeated rows with one id are one vector, of several
different ones the least by label and then by components (nulls first); rows without
an id are left out; an empty table gives an empty table; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, arrow_map, one_row, ranked
from tagloom.llm.components import components

COSINE = 0.93
PASSES, BITS, WINDOW = 5, 48, 256
#: Places of a block of a pass.
PLACES = 2048
#: Blocks of a label in the completion, at most, unless a block would hold more than so many bytes.
LEAST, SPREAD, BLOCK_BYTES = 512, 4, 16 << 20
#: Rows and columns of a tile of the matrix product.
TILE = (512, 2048)
SEED = 7919
#: Slack of the bound on angles, far above the rounding of a double.
SLACK = 1e-6

_LINKS = "rep long, n long, passed long, a long, b long"


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _runs(batch: pa.RecordBatch, *columns: str) -> list[tuple[tuple, int, int]]:
    """The runs of rows with equal values in ``columns``: values, start and end."""
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns], axis=1)
    edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
    return [(tuple(keys[x].tolist()), x, y) for x, y in zip(edges[:-1], edges[1:], strict=True) if x < y]


def _grouped(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, pa.Table]]:
    """Sorted rows, group by group."""
    kept, last = [], None
    for batch in batches:
        for key, x, y in _runs(batch, *columns):
            if kept and key != last:
                yield last, pa.Table.from_batches(kept).combine_chunks()
                kept = []
            kept.append(batch.slice(x, y - x))
            last = key
    if kept:
        yield last, pa.Table.from_batches(kept).combine_chunks()


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins the trees of the linked rows in ``root``, in place; the roots that were joined."""
    low, high = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return np.concatenate(low), np.concatenate(high)
        a, b = a[apart], b[apart]
        least, most = np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])
        most, first = np.unique(most, return_index=True)
        root[most] = least[first]
        low.append(least[first])
        high.append(most)
        while (root[root] != root).any():
            root[:] = root[root]


class _Links:
    """Link counts of a unit's rows and the edges that join its linked rows."""

    def __init__(self, rows: pa.Table):
        self.rep, self.m = (rows.column(c).to_numpy() for c in ("rep", "m"))
        self.places = _matrix(rows.column("places").chunk(0)).astype(np.int64)
        self.count = np.zeros(len(self.rep), np.int64)
        self.root = np.arange(len(self.rep))
        self.low, self.high = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def add(self, a: np.ndarray, b: np.ndarray, passes: int) -> None:
        """Take the linked pairs that none of the first ``passes`` passes has seen."""
        seen = (np.abs(self.places[a, :passes] - self.places[b, :passes]) <= WINDOW).any(axis=1)
        a, b = a[~seen], b[~seen]
        n = len(self.rep)
        self.count += (np.bincount(a, self.m[b], n) + np.bincount(b, self.m[a], n)).astype(np.int64)
        for kept, x in zip((self.low, self.high), _joined(self.root, a, b), strict=True):
            kept.append(x)

    def batch(self, passed: bool) -> pa.RecordBatch:
        some = np.flatnonzero(self.count)
        low, high = self.rep[np.concatenate(self.low)], self.rep[np.concatenate(self.high)]
        no_edge, no_count = pa.nulls(len(some), pa.int64()), pa.nulls(len(low), pa.int64())
        n = self.count[some]
        columns = ((self.rep[some], no_count), (n, no_count), (n * passed, no_count), (no_edge, low), (no_edge, high))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())]) for x, y in columns], names=["rep", "n", "passed", "a", "b"]
        )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of each label and size, batch by batch."""
    for given in batches:
        batch, out = given.sort_by([("label", "ascending"), ("size", "ascending")]), []
        for (label, size), x, y in _runs(batch, "label", "size"):
            vectors = unit(_matrix(batch.column("vector").slice(x, y - x)))
            out.append((label, size, vectors.sum(axis=0).tolist(), y - x))
        if out:
            names, kinds = ("label", "size", "total", "n"), (pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=list(names))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key for each pass: the signs of ``BITS`` projections of the centred vector."""
    planes: dict[int, np.ndarray] = {}
    places = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for given in batches:
        batch = given.sort_by([("label", "ascending"), ("size", "ascending")])
        keys = np.empty((batch.num_rows, PASSES), np.int64)
        for (_, size), x, y in _runs(batch, "label", "size"):
            if size not in planes:  # one size is held at a time
                planes = {size: np.random.default_rng((SEED, size)).standard_normal((PASSES, size, BITS))}
            centred = unit(_matrix(batch.column("vector").slice(x, y - x))) - np.array(batch.column("mean")[x].as_py())
            for k in range(PASSES):
                keys[x:y, k] = (centred @ planes[size][k] > 0) @ places
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, PASSES), pa.int32()), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rep", "label", "size")), lists], names=["rep", "label", "size", "keys"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each vector with the places after it; rows come sorted by (pass, block, place)."""
    for (k, block), rows in _grouped(batches, "pass", "block"):
        links = _Links(rows)
        place = rows.column("place").to_numpy()
        whole = rows.combine_chunks().to_batches()[0]
        for _, x, y in _runs(whole, "label", "size"):
            vectors = unit(_matrix(whole.column("vector").slice(x, y - x)))
            for at in range(0, y - x, WINDOW):
                end = min(at + 2 * WINDOW, y - x)
                near = vectors[at : at + WINDOW] @ vectors[at:end].T >= COSINE
                a, b = np.nonzero(near)
                a, b = a + at + x, b + at + x
                own = (place[a] < place[b]) & (place[b] - place[a] <= WINDOW) & (place[a] // PLACES == block)
                links.add(a[own], b[own], k)
        yield links.batch(True)


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre and radius (the largest angle to the centre) of each block; rows come sorted by (label, size, own)."""
    names = ["label", "size", "own", "centre", "radius"]
    for (label, size, own), rows in _grouped(batches, "label", "size", "own"):
        vectors = unit(_matrix(rows.column("vector").chunk(0)))
        centre = vectors.sum(axis=0)
        length = float(np.sqrt(centre @ centre))
        centre = centre / length if length > 1e-9 else vectors[0]
        radius = float(np.arccos(np.clip((vectors @ centre).min(), -1, 1)))
        row = (pa.array([label], pa.int64()), pa.array([size], pa.int32()), pa.array([own], pa.int32()), pa.array([centre.tolist()]), pa.array([radius]))
        yield pa.RecordBatch.from_arrays(list(row), names=names)


def _completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a pair of blocks that no pass has seen; rows come sorted by (label, size, bi, bj)."""
    for (_, _, bi, bj), rows in _grouped(batches, "label", "size", "bi", "bj"):
        own = rows.column("own").to_numpy()
        left, right = np.flatnonzero(own == bi), np.flatnonzero(own == bj)
        vectors = unit(_matrix(rows.column("vector").chunk(0)))
        links = _Links(rows)
        for x in range(0, len(left), TILE[0]):
            i = left[x : x + TILE[0]]
            for y in range(x // TILE[1] * TILE[1] if bi == bj else 0, len(right), TILE[1]):
                j = right[y : y + TILE[1]]
                a, b = np.nonzero(vectors[i] @ vectors[j].T >= COSINE)
                if bi == bj:
                    once = a + x < b + y
                    a, b = a[once], b[once]
                links.add(i[a], j[b], PASSES)
        yield links.batch(False)


def _placed(sized: DataFrame, staged: Staged) -> DataFrame:
    """Every class with ``places``, its place in each pass."""
    sums = sized.select("label", "size", "vector").transform(arrow_map, _sums, "label long, size int, total array<double>, n long")
    counts = sums.groupBy("label", "size").agg(F.sum("n").alias("n"))
    parts = sums.select("label", "size", F.posexplode("total").alias("pos", "part")).groupBy("label", "size", "pos").agg(F.sum("part").alias("part"))
    means = (
        parts.groupBy("label", "size")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "part"))).alias("parts"))
        .join(counts, ["label", "size"])
        .select("label", "size", F.transform("parts", lambda p: p["part"] / F.col("n")).alias("mean"))
    )
    keyed = sized.join(staged.write(means, "means"), ["label", "size"]).select("rep", "label", "size", "vector", "mean")
    keyed = staged.write(keyed.transform(arrow_map, _keys, "rep long, label long, size int, keys array<long>"), "keys")
    rows = keyed.select("rep", "label", "size", F.posexplode("keys").alias("pass", "key"))
    rows = rows.withColumn("tie", F.xxhash64("pass", "rep"))
    order = ranked(rows, ("pass", "label", "size", "key", "tie", "rep"), staged, "order", "place")
    places = order.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("pass", "place"))).alias("order"))
    places = places.select("rep", F.col("order.place").alias("places"))
    return staged.write(sized.join(places, "rep"), "placed")


def _passes(placed: DataFrame) -> DataFrame:
    rows = placed.select("*", F.posexplode("places").alias("pass", "place"))
    block = F.floor(F.col("place") / PLACES)
    # the first places of a block also end the block before it
    into = F.when((F.col("place") % PLACES < WINDOW) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    dealt = rows.withColumn("block", F.explode(into)).select("pass", "block", "place", "label", "size", "rep", "m", "places", "vector")
    dealt = dealt.repartition("pass", "block").sortWithinPartitions("pass", "block", "place")
    return dealt.transform(arrow_map, _windows, _LINKS)


def _completion(placed: DataFrame, staged: Staged) -> DataFrame:
    first = F.col("places")[0]
    n, most = F.count(F.lit(1)), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("size"))))
    sizes = placed.groupBy("label", "size").agg(n.alias("n"), F.min(first).alias("start"))
    blocks = F.greatest(F.least(F.ceil(F.col("n") / LEAST), F.lit(SPREAD)), F.ceil(F.col("n") / most)).alias("blocks")
    sizes = staged.write(sizes.select("label", "size", "n", "start", blocks), "sizes")
    own = F.floor((first - F.col("start")) * F.col("blocks") / F.col("n")).cast("int").alias("own")
    cut = placed.join(sizes, ["label", "size"]).select("label", "size", own, "rep", "m", "places", "vector")
    balls = (
        cut.select("label", "size", "own", "vector")
        .repartition("label", "size", "own")
        .sortWithinPartitions("label", "size", "own")
        .transform(arrow_map, _balls, "label long, size int, own int, centre array<double>, radius double")
    )
    balls = staged.write(balls, "balls")
    side = lambda k: balls.select("label", "size", F.col("own").alias(f"b{k}"), F.col("centre").alias(f"c{k}"), F.col("radius").alias(f"r{k}"))
    dot = F.aggregate(F.zip_with("ci", "cj", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    nearest = F.acos(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0))) - F.col("ri") - F.col("rj")
    meeting = side("i").join(side("j"), ["label", "size"]).where("bi <= bj").where(nearest <= float(np.arccos(COSINE)) + SLACK)
    meeting = meeting.select("label", "size", "bi", "bj")
    # a block goes to each of its block pairs; a pair of one block with itself takes its rows once
    ends = meeting.select("*", F.explode(F.array_distinct(F.array("bi", "bj"))).alias("own"))
    dealt = cut.join(ends, ["label", "size", "own"]).select("label", "size", "bi", "bj", "own", "rep", "m", "places", "vector")
    dealt = dealt.repartition("label", "size", "bi", "bj").sortWithinPartitions("label", "size", "bi", "bj")
    return dealt.transform(arrow_map, _completed, _LINKS)


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept and n_pass_links of each vector."""
    staged = Staged(vectors.sparkSession, "embedding")
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # a float becomes a double without loss, in the units
    given = vectors.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast(kind).alias("vector")
    )
    own = one_row(given, "vec_id", "label", "vector")
    sound = (
        F.col("label").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    # a copy finds its class by a hash of the vector and then by the vector itself
    marked = own.withColumn("print", F.when(sound, F.xxhash64("label", "vector")))
    classes = staged.write(
        marked.where("print is not null").groupBy("print", "label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m")),
        "classes",
    )
    placed = _placed(classes.select("rep", "m", "label", F.size("vector").alias("size"), "vector"), staged)
    found = staged.write(_passes(placed).union(_completion(placed, staged)), "found")
    links = found.where("rep is not null").groupBy("rep").agg(F.sum("n").alias("n"), F.sum("passed").alias("passed"))
    label = staged.write(components(found.where("a is not null").select("a", "b"), staged), "label")
    none = F.lit(0).cast("long")
    ends = (
        classes.join(links, "rep", "left")
        .join(label, F.col("rep") == F.col("node"), "left")
        .select(
            "print",
            F.col("label").alias("class_label"),
            F.col("vector").alias("class_vector"),
            (F.coalesce("n", none) + F.col("m") - 1).alias("n"),
            F.coalesce("passed", none).alias("passed"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return (
        marked.join(ends, ["print"], "left")
        .where("class_vector is null or (class_vector = vector and class_label = label)")
        .select("vec_id", F.coalesce("n", none).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), F.coalesce("passed", none).alias("n_pass_links"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
