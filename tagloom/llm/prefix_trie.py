"""Conversation prefix trie by vertical bitmaps.

Conversations are ordered by turn (null first; equal turns by role, then by the
first ``TIE`` characters of the text, then by its MD5). With h = crc32(decimal c) % 4,
conversation c is rebuilt from the first h turns of conversation c - c % 20 and its
own turns after its first h (``rebuilt``). Every distinct sequence of first d turns is
a node of depth d. The steps:

1. Texts stay where they are: a turn is its role, the MD5 of its text and its word
   count. A range shuffle gives each turn its place (``common.ranked``), so one
   conversation may hold any share of the rows.
2. Conversations are dealt into shards of ``CONVS`` consecutive ids and bands of
   ``BAND`` positions; a unit of work (shard, band) is bounded. A unit starts from
   the hash of what stands before its band, the xor of the hashes of (position, turn).
3. A unit indexes (position, turn) to a bitset of its conversations and goes down
   depth first: a parent's bitset and a posting give a child's bitset, its popcount
   the members, its lowest bit the smallest one, its overlap with the conversations
   that end there the end list. Each posting that is met gives one child.
4. The units' nodes are summed by hash; ids of end lists are hashed in ascending order
   from the shards' lists, which a task reads one after the other.
5. Sums over subtrees need no walk: a conversation that is the smallest member of a
   node is so for the rest of its path. So a node's sum is that of its owner's own
   nodes from there on, and all that its other members own. The same units, cut to
   the part of each path that its conversation doesn't own, add up the latter.

A SHA-256 has to see its ids one after the other, so the end list of one node is
read by one task, as lists of up to ``CONVS`` ids (9 bytes an id, never all in memory).

Defined results: null role and text are empty; rows without an id are left out;
repeated rows are turns of their own; a turnless rebuilt conversation ends in the
root; no conversations give no root, so an empty table gives an empty table; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, arrow_map, ranked

#: Consecutive ids of a shard, and positions of a band.
CONVS, BAND = 2048, 64
#: Conversations that share a base, shared turns at most, and characters that order equal turns.
GROUP, MOST_SHARED, TIE = 20, 3, 32
#: Rows of a batch that goes out.
_OUT = 20_000

_NODES = "n1 long, n2 long, p1 long, p2 long, depth long, n long, conv_id long, words long, block long, ends array<long>"
_SHARED = "n1 long, n2 long, weight long, leaves long"


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``tie``, ``md5`` and ``words`` of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, TIE).alias("tie"),
        F.md5(text.cast("binary")).alias("md5"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame, staged: Staged) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, pos, h1, h2, words) and every conversation's (conv_id, len)."""
    rows = ranked(turns, ("conv_id", "turn", "role", "tie", "md5"), staged, "turns").select(
        "conv_id",
        "rank",
        F.xxhash64("role", "md5").alias("h1"),
        F.xxhash64(F.lit(1), "role", "md5").alias("h2"),
        "words",
    )
    own = rows.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    shared = F.when(base == F.col("conv_id"), 0).otherwise(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4)
    wants = own.select("conv_id", "first", "n", base.alias("base"), shared.cast("long").alias("h"))
    has = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = staged.write(
        wants.join(has, "base", "left").select(
            "conv_id", "first", "n", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k")
        ),
        "convs",
    )
    at = F.col("rank") - F.col("first")
    placed = rows.join(convs, "conv_id").withColumn("at", at)
    tail = placed.where("at >= h").select("conv_id", (F.col("at") - F.col("h") + F.col("k")).alias("pos"), "h1", "h2", "words")
    # a base gives at most three turns to each of its group's conversations
    lent = (
        placed.where((F.col("at") < MOST_SHARED) & (F.col("conv_id") == F.col("base")))
        .select(F.col("conv_id").alias("base"), F.col("at").alias("pos"), "h1", "h2", "words")
        .join(convs.where("h > 0").select("conv_id", "base", "h"), "base")
        .where("pos < h")
        .select("conv_id", "pos", "h1", "h2", "words")
    )
    length = F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("k")
    return tail.union(lent), convs.select("conv_id", length.alias("len"))


def _units(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the units' turns (conv_id, block, band, pos, k1, k2, words) and starts (conv_id, block, band, k1, k2, len)."""
    block = F.floor(F.col("conv_id") / CONVS).cast("long").alias("block")
    keyed = turns.select(
        "conv_id",
        block,
        (F.col("pos") - F.col("pos") % BAND).alias("band"),  # its first position
        "pos",
        F.xxhash64("pos", "h1", "h2").alias("k1"),
        F.xxhash64(F.lit(1), "pos", "h1", "h2").alias("k2"),
        "words",
    )
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = keyed.groupBy("conv_id", "band").agg(F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"))
    none = F.lit(0).cast("long")
    begun = bands.select("conv_id", "band", *(F.coalesce(F.bit_xor(x).over(before), none).alias(k) for x, k in (("x1", "k1"), ("x2", "k2"))))
    starts = (
        begun.join(convs, "conv_id")
        .select("conv_id", block, "band", "k1", "k2", "len")
        .union(convs.where("len = 0").select("conv_id", block, none, none, none, "len"))
    )
    return keyed, starts


def _sorted_units(turns: DataFrame, starts: DataFrame) -> DataFrame:
    """Turns and starts together, dealt by unit; a unit's starts come first, then its turns by position."""
    rows = turns.unionByName(starts, allowMissingColumns=True)
    return rows.repartition("block", "band").sortWithinPartitions("block", "band", F.asc_nulls_first("pos"))


def _each_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    kept, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("block", "band")], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if kept and not np.array_equal(last, keys[x]):
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(x, y - x))
            last = keys[x]
    if kept:
        yield pa.Table.from_batches(kept)


class _Unit:
    """The vertical index of a unit: bitsets of local conversations, in ascending order of id."""

    def __init__(self, rows: pa.Table):
        column = {c: rows.column(c).to_pylist() for c in ("conv_id", "pos", "k1", "k2")}
        self.block, self.base = rows.column("block")[0].as_py(), rows.column("band")[0].as_py()
        n_starts = rows.column("pos").null_count
        self.order = sorted(range(n_starts), key=column["conv_id"].__getitem__)
        self.conv = [column["conv_id"][i] for i in self.order]
        bit = {c: i for i, c in enumerate(self.conv)}
        self.starts: dict[tuple[int, int], int] = defaultdict(int)
        for i, row in enumerate(self.order):
            self.starts[column["k1"][row], column["k2"][row]] |= 1 << i
        postings: dict[tuple[int, int, int], int] = {}
        self.bits: list[int] = []
        self.keys: list[tuple[int, int]] = []
        self.row: list[int] = []
        self.turns: list[list[int]] = [[] for _ in self.conv]
        for row in range(n_starts, len(rows)):
            key = column["pos"][row], column["k1"][row], column["k2"][row]
            posting = postings.setdefault(key, len(self.bits))
            if posting == len(self.bits):
                self.bits.append(0)
                self.keys.append(key[1:])
                self.row.append(row)
            own = bit[column["conv_id"][row]]
            self.bits[posting] |= 1 << own
            self.turns[own].append(posting)
        self.going: dict[int, int] = defaultdict(int)
        for i, own in enumerate(self.turns):
            for d in range(len(own)):
                self.going[d] |= 1 << i

    def walk(self) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """Each node below the starts, depth first: its hash, its parent's, depth, members, posting."""
        stack = [(members, 0, *start) for start, members in self.starts.items()]
        while stack:
            members, d, p1, p2 = stack.pop()
            rest = members & self.going[d]
            while rest:
                posting = self.turns[(rest & -rest).bit_length() - 1][d]
                child = members & self.bits[posting]
                rest &= ~child
                k1, k2 = self.keys[posting]
                n1, n2 = p1 ^ k1, p2 ^ k2
                yield n1, n2, p1, p2, self.base + d + 1, child, posting
                stack.append((child, d + 1, n1, n2))


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")), strict=True)
    kind = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kind[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each unit, with members, smallest member and the ids that end there."""
    out: list[tuple] = []
    for rows in _each_unit(batches):
        unit = _Unit(rows)
        length, words = rows.column("len").to_pylist(), rows.column("words").to_pylist()
        ending: dict[int, int] = defaultdict(int)
        for i, row in enumerate(unit.order):
            ending[length[row]] |= 1 << i

        def entry(n1: int, n2: int, p1, p2, depth: int, members: int, own_words: int) -> tuple:
            ends = [unit.conv[i] for i in _bits(members & ending.get(depth, 0))]  # noqa: B023
            low = unit.conv[(members & -members).bit_length() - 1]  # noqa: B023
            return n1, n2, p1, p2, depth, members.bit_count(), low, own_words, unit.block, ends or None  # noqa: B023

        if unit.base == 0:
            out.append(entry(0, 0, None, None, 0, (1 << len(unit.conv)) - 1, 0))
        for n1, n2, p1, p2, depth, members, posting in unit.walk():
            out.append(entry(n1, n2, p1, p2, depth, members, words[unit.row[posting]]))
            if len(out) >= _OUT:
                yield _batch(out, _NODES)
                out = []
    if out:
        yield _batch(out, _NODES)


def _shared_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node of each unit the sums of its members' weights and leaves."""
    out: list[tuple] = []
    for rows in _each_unit(batches):
        unit = _Unit(rows)
        weights, leaves = rows.column("weight").to_pylist(), rows.column("leaf").to_pylist()
        weight = [weights[row] for row in unit.order]
        leaf = [leaves[row] for row in unit.order]

        def sums(members: int) -> tuple[int, int]:
            own = list(_bits(members))
            return sum(weight[i] for i in own), sum(leaf[i] for i in own)  # noqa: B023

        if unit.base == 0:
            out.append((0, 0, *sums((1 << len(unit.conv)) - 1)))
        for n1, n2, _, _, _, members, _ in unit.walk():
            out.append((n1, n2, *sums(members)))
            if len(out) >= _OUT:
                yield _batch(out, _SHARED)
                out = []
    if out:
        yield _batch(out, _SHARED)


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids that end in each node; rows come sorted by (n1, n2, block)."""
    last, state = None, None

    def done(keys: list[tuple], hashes: list[str]) -> pa.RecordBatch:
        n1, n2 = zip(*keys, strict=True)
        columns = [pa.array(n1, pa.int64()), pa.array(n2, pa.int64()), pa.array(hashes, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["n1", "n2", "ends_sha256"])

    for batch in batches:
        keys, hashes = [], []
        columns = (batch.column(c).to_pylist() for c in ("n1", "n2"))
        for k, key in enumerate(zip(*columns, strict=True)):
            ids = ",".join(map(str, batch.column("ends")[k].as_py())).encode()
            if key == last:
                state.update(b"," + ids)
                continue
            if last is not None:
                keys.append(last)
                hashes.append(state.hexdigest())
            last, state = key, hashlib.sha256(ids)
        if keys:
            yield done(keys, hashes)
    if last is not None:
        yield done([last], [state.hexdigest()])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    staged = Staged(conversations.sparkSession, "trie")
    turns, convs = rebuilt(turns_of(conversations), staged)
    keyed, starts = _units(staged.write(turns, "rebuilt"), convs)
    starts = staged.write(starts, "starts")
    rows = _sorted_units(keyed, starts).select("block", "band", "conv_id", "pos", "k1", "k2", "words", "len")
    parts = staged.write(rows.transform(arrow_map, _nodes, _NODES), "parts")

    nodes = staged.write(
        parts.groupBy("n1", "n2").agg(
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.min("depth").alias("depth"),
            F.sum("n").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.min("words").alias("words"),
            F.sum(F.coalesce(F.size("ends"), F.lit(0))).alias("n_ends"),
        ),
        "nodes",
    )
    single = F.col("n_convs") == 1
    # a node of one conversation has one child, or none where the conversation ends
    kids = nodes.where("p1 is not null").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    shared = staged.write(
        nodes.where(~single)
        .join(kids, ["n1", "n2"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("own", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("band", F.col("depth") - F.col("depth") % BAND),
        "shared",
    )
    alone = nodes.where(single).withColumn("n_children", 1 - F.col("n_ends"))

    ending = F.when(F.col("n_children") == 0, 1).otherwise(0)
    tops = shared.select("conv_id", "depth", "p1", "p2", "own", ending.alias("leaf")).union(
        alone.select("conv_id", "depth", "p1", "p2", F.lit(0), ending)
    )
    owners = staged.write(
        tops.groupBy("conv_id").agg(
            F.min(F.struct("depth", "p1", "p2")).alias("top"), F.sum("own").cast("long").alias("weight"), F.max("leaf").cast("long").alias("leaf")
        ),
        "owners",
    )
    above = owners.select("conv_id", F.col("top.p1").alias("n1"), F.col("top.p2").alias("n2")).where("n1 is not null")
    parents = above.join(nodes.where(~single).select("n1", "n2", F.col("conv_id").alias("parent")), ["n1", "n2"]).select("conv_id", "parent")
    owned = staged.write(
        owners.join(parents, "conv_id", "left").select("conv_id", F.col("top.depth").alias("top"), "weight", "leaf", "parent"), "owned"
    )

    # what members that aren't the owner own: the units again, cut to the paths above each conversation's own nodes
    giving = owned.where("top > 0 and (weight > 0 or leaf > 0)").select("conv_id", "top", "weight", "leaf")
    over = keyed.join(giving.select("conv_id", "top"), "conv_id").where("pos + 1 < top").drop("top", "words")
    begun = starts.join(giving, "conv_id").where("band = 0 or band + 1 < top").drop("top", "len")
    again = _sorted_units(over, begun).select("block", "band", "conv_id", "pos", "k1", "k2", "weight", "leaf")
    given = again.transform(arrow_map, _shared_sums, _SHARED).groupBy("n1", "n2").agg(F.sum("weight").alias("weight"), F.sum("leaves").alias("leaves"))

    # what the owner owns from a node on: within its band, and the bands below
    inner = Window.partitionBy("conv_id", "band").orderBy(F.desc("depth"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = shared.groupBy("conv_id", "band").agg(F.sum("own").alias("in_band"))
    bands = bands.select("conv_id", "band", F.coalesce(F.sum("in_band").over(below), F.lit(0)).alias("under"))
    hashes = (
        parts.where("ends is not null")
        .join(shared.select("n1", "n2"), ["n1", "n2"], "left_semi")
        .select("n1", "n2", "block", "ends")
        .repartition("n1", "n2")
        .sortWithinPartitions("n1", "n2", "block")
        .transform(arrow_map, _end_hashes, "n1 long, n2 long, ends_sha256 string")
    )
    many = (
        shared.withColumn("from_here", F.sum("own").over(inner))
        .join(bands, ["conv_id", "band"])
        .join(given, ["n1", "n2"], "left")
        .join(hashes, ["n1", "n2"], "left")
    )
    empty = hashlib.sha256(b"").hexdigest()
    kept = ("conv_id", "depth", "n_convs", "n_children")
    told = many.join(owned.select("conv_id", "leaf"), "conv_id").select(
        *kept,
        (F.col("leaf") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.col("from_here") + F.col("under") + F.coalesce("weight", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
    own_hash = F.when(F.col("n_ends") > 0, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(empty))
    told = told.unionByName(alone.select(*kept, F.lit(1).alias("n_leaves"), F.lit(0).alias("saved_tokens"), own_hash.alias("ends_sha256")))
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent"))
    return told.join(owned.select("conv_id", "top", "parent"), "conv_id").select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        F.col("n_convs").cast("long").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"),
        "ends_sha256",
    )
