"""Source divergence audit: one-hot level products price how far sources of a language stand apart.

Terms are matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A
language keeps the terms that stand in at least ``MIN_DOCS`` of its documents (V
of them). A group (language, source), and each language, gives a kept term with
``count`` occurrences the price p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)),
N the sum of its counts. The steps:

1. One map pass counts the terms of whole texts; a task sums its counts and
   gives them out once ``HELD`` are at hand, so its memory is bounded. They are
   dealt by (language, term), where counts and document counts are summed.
2. A price depends on a term only through its count level. Each group has one
   indicator column over the terms for every level above 0. The kept terms of a
   language are dealt into blocks of about ``TERMS``, its sources into blocks of
   about ``SOURCES``; each (term block, pair of source blocks) is a unit of work
   whose indicator columns, multiplied by their transpose, count the terms of
   each pair of levels. The products are 0/1 sums far below 2**24, so exact in
   single precision. Summed over the term blocks they are the joint tables.
3. Spark prices the joint tables. With f(a, b) the difference of the prices of
   levels a and b of two groups, the sum over all terms is, exactly,
   V f(0,0) + sum n1(a) (f(a,0) - f(0,0)) + sum n2(b) (f(0,b) - f(0,0))
   + sum n(a,b) (f(a,b) - f(a,0) - f(0,b) + f(0,0)),
   so terms that a source lacks are never listed for it.

Defined results: null text, lang and source are ''; a group without terms, or of
a language without kept terms, still stands in pairs; repeated rows count once
each; ties rank by item; an empty table gives an empty table; ids and extra
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, arrow_map
from tagloom.llm.wordhash import slices

MIN_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Entries that a counting task holds before it gives them out.
HELD = 200_000
#: Terms and sources that a block holds, about, and columns of a tile of the product.
TERMS, SOURCES, TILE = 512, 16, 2048

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_COUNTED = "lang string, source string, term string, n long, docs long"
_JOINT = "lang string, source1 string, level1 long, source2 string, level2 long, n long"


def _counts_batch(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
    lang, source, term, n, docs = [], [], [], [], []
    for (own_lang, own_source), (counts, documents) in held.items():
        lang += [own_lang] * len(counts)
        source += [own_source] * len(counts)
        term += counts.keys()
        n += counts.values()
        docs += [documents[t] for t in counts]
    columns = [
        pa.array(lang, pa.string()),
        pa.array(source, pa.string()),
        pa.array(term, pa.binary()).cast(pa.string()),
        pa.array(n, pa.int64()),
        pa.array(docs, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = 0
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for key, text in zip(keys, texts, strict=True):
                counts, documents = held.setdefault(key, (Counter(), Counter()))
                before = len(counts)
                own = Counter(_TERM.findall(text.lower()))
                counts.update(own)
                documents.update(own.keys())
                entries += len(counts) - before
                if entries >= HELD:
                    yield _counts_batch(held)
                    held, entries = {}, 0
    if held:
        yield _counts_batch(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n``, ``lang_n`` of every kept term that the source holds, and ``leads`` (true once a term)."""
    texts = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    of_term = Window.partitionBy("lang", "term")
    return (
        texts.transform(arrow_map, _counted, _COUNTED)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumn("lang_docs", F.sum("docs").over(of_term))
        .withColumn("lang_n", F.sum("n").over(of_term))
        .withColumn("leads", F.min("source").over(of_term) == F.col("source"))
        .where(F.col("lang_docs") >= MIN_DOCS)
        .select("lang", "source", "term", "n", "lang_n", "leads")
    )


def _unit_product(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Joint level counts of the sources of a pair of source blocks over the terms of one term block."""
    rows = rows.combine_chunks()
    term = rows.column("term").chunk(0).dictionary_encode().indices.to_numpy()
    sources = rows.column("source").chunk(0).dictionary_encode()
    names = sources.dictionary
    levels, level = np.unique(rows.column("n").to_numpy(), return_inverse=True)
    keys, column = np.unique(sources.indices.to_numpy().astype(np.int64) * len(levels) + level, return_inverse=True)
    hot = np.zeros((int(term.max()) + 1, len(keys)), np.float32)
    hot[term, column] = 1
    block = np.zeros(len(keys), np.int64)
    block[column] = rows.column("own").to_numpy()
    source = keys // len(levels)
    left = np.flatnonzero(block == rows.column("bi")[0].as_py())
    right = np.flatnonzero(block == rows.column("bj")[0].as_py())
    order = np.argsort(np.array([x.encode() for x in names.to_pylist()], dtype=object))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    same = rows.column("bi")[0].as_py() == rows.column("bj")[0].as_py()
    for x in range(0, len(left), TILE):
        for y in range(0, len(right), TILE):
            i, j = left[x : x + TILE], right[y : y + TILE]
            product = hot[:, i].T @ hot[:, j]
            a, b = np.nonzero(product)
            n = product[a, b].astype(np.int64)
            a, b = i[a], j[b]
            if same:
                once = place[source[a]] < place[source[b]]
                a, b, n = a[once], b[once], n[once]
            else:
                turned = place[source[a]] > place[source[b]]
                a, b = np.where(turned, b, a), np.where(turned, a, b)
            if len(n):
                columns = [
                    pa.array([rows.column("lang")[0].as_py()] * len(n), pa.string()),
                    names.take(pa.array(source[a])).cast(pa.string()),
                    pa.array(levels[keys[a] % len(levels)], pa.int64()),
                    names.take(pa.array(source[b])).cast(pa.string()),
                    pa.array(levels[keys[b] % len(levels)], pa.int64()),
                    pa.array(n, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source1", "level1", "source2", "level2", "n"])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_unit_product`` of each unit; rows come sorted by (lang, tb, bi, bj)."""
    kept, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "tb", "bi", "bj")), strict=True))
        edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if kept and last != keys[x]:
                yield from _unit_product(pa.Table.from_batches(kept))
                kept = []
            kept.append(batch.slice(x, y - x))
            last = keys[x]
    if kept:
        yield from _unit_product(pa.Table.from_batches(kept))


def joint_tables(kept: DataFrame) -> DataFrame:
    """For each two sources of a language (source1 < source2): the number of terms of each pair of levels above 0."""
    blocks = kept.groupBy("lang").agg(
        F.ceil(F.count_if("leads") / TERMS).cast("int").alias("term_blocks"),
        F.ceil(F.count_distinct("source") / SOURCES).cast("int").alias("source_blocks"),
    )
    units = (
        kept.join(blocks, "lang")
        .withColumn("tb", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("source"), F.col("source_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1)))
        .select("lang", "tb", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "source", "term", "n")
    )
    dealt = units.repartition("lang", "tb", "bi", "bj").sortWithinPartitions("lang", "tb", "bi", "bj")
    return (
        dealt.transform(arrow_map, _products, _JOINT)
        .groupBy("lang", "source1", "level1", "source2", "level2")
        .agg(F.sum("n").alias("n"))
    )


def price(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers; 1 where there are no terms."""
    count, total, terms = (F.col(c) if isinstance(c, str) else c for c in (count, total, terms))
    over = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    under = (total + F.lit(PRIOR) * terms).cast("decimal(20,0)")
    whole = F.call_function("div", over, under)
    return F.when(terms > 0, whole + 1).otherwise(F.lit(1)).cast("long")


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of each source and each other source of its language."""
    side = lambda k: groups.select("lang", *(F.col(c).alias(f"{c}{k}") for c in ("source", "total")), *(["terms"] if k == 1 else []))
    ends = side(1).join(side(2), "lang").where("source1 < source2")
    p = lambda k, level: price(level, f"total{k}", "terms")
    none1, none2 = p(1, F.lit(0)), p(2, F.lit(0))
    f00 = F.abs(none1 - none2)
    joint = joint_tables(kept).join(ends, ["lang", "source1", "source2"])
    f11 = F.abs(p(1, "level1") - p(2, "level2"))
    f10, f01 = F.abs(p(1, "level1") - none2), F.abs(none1 - p(2, "level2"))
    both = joint.select("lang", "source1", "source2", (F.col("n") * (f11 - f10 - f01 + f00)).alias("v"))
    levels = kept.groupBy("lang", "source", F.col("n").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    first = levels.withColumnsRenamed({"source": "source1", "level": "level1"}).join(ends, ["lang", "source1"])
    second = levels.withColumnsRenamed({"source": "source2", "level": "level2"}).join(ends, ["lang", "source2"])
    alone = first.select("lang", "source1", "source2", (F.col("n") * (f10 - f00)).alias("v")).union(
        second.select("lang", "source1", "source2", (F.col("n") * (f01 - f00)).alias("v"))
    )
    ground = ends.select("lang", "source1", "source2", (F.col("terms") * f00).alias("v"))
    value = both.union(alone).union(ground).groupBy("lang", "source1", "source2").agg(F.sum("v").alias("value"))
    turned = F.array(
        F.struct(F.col("source1").alias("source"), F.col("source2").alias("item")),
        F.struct(F.col("source2").alias("source"), F.col("source1").alias("item")),
    )
    return value.select("lang", F.explode(turned).alias("e"), "value").select("lang", "e.source", "e.item", "value")


def audit(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: how far each source stands from the others, and by which terms."""
    staged = Staged(docs.sparkSession, "divergence")
    kept = staged.write(term_counts(docs), "kept")
    langs = kept.groupBy("lang").agg(F.count_if("leads").alias("terms"), F.sum(F.when(F.col("leads"), F.col("lang_n"))).alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = staged.write(
        docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")))
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"]),
        "groups",
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(kept, groups).withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
    own, whole = price("n", "total", "terms"), price("lang_n", "lang_total", "terms")
    terms = (
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value"))
        .where("value > 0")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= TOP_TERMS)
        .withColumn("part", F.lit("term"))
    )
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.select(*columns).union(terms.select(*columns))
