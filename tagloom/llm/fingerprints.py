"""Document fingerprints (native): bottom-k sketches of shingle hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A shingle is five words in
a row; four empty words lead the text, so a text of n words has n shingles and
a short one has some too. A document's sketch holds the ``K`` smallest of the
distinct 64-bit hashes of its shingles, ascending. Sketches merge: the ``K``
smallest of the union of two are the sketch of both texts' shingles. They
estimate

* resemblance: of the ``K`` smallest hashes of the union, the share that both hold;
* distinct shingles: all of them below ``K``, else (K - 1) / (the K-th hash as a
  fraction of the hash range);
* containment: resemblance times distinct shingles of the union, over those of one.

``merged`` gives the sketch of any group of documents; it ranks hashes with a
limit that each task applies before its shuffle, so a source that holds a third of
all documents costs ``K`` rows a task.

``compare_edited`` compares every document with its edited text and with the
next document. Next documents are found among the ids alone (a range shuffle,
then a join on consecutive ranks); texts meet the start of the next text in two
joins on the id, so no order passes through one task and no text is broadcast.

Defined results: a null text is empty; an empty or blank text has an empty
sketch, alike (1.0) to an empty one and to no other (0.0); rows without an id are
left out of ``compare_edited``; rows that repeat an id are compared each on its
own, and of several texts of the next id the one with the smallest hash counts; a
single document is its own next; an empty table gives an empty table; only doc_id
and text (and the group columns of ``merged``) are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, ascii_lower, let, ranked

K = 64
SHINGLE = 5


def word_list(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _least(hashes: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, K)


def sketch(text: Column) -> Column:
    """The ``K`` smallest distinct shingle hashes of a text, ascending; null counts as empty."""
    words = F.transform(word_list(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))
    led = F.concat(F.array_repeat(F.lit(0).cast("long"), SHINGLE - 1), words)

    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - SHINGLE)
        shingles = F.transform(places, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))
        return F.when(F.size(w) >= SHINGLE, _least(shingles)).otherwise(F.array().cast("array<long>"))

    return let(led, hashes)


def union_sketch(a: Column, b: Column) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, K)


def distinct_shingles(own: Column) -> Column:
    """Estimated number of distinct shingles behind a sketch; exact below ``K``."""
    part = (F.element_at(own, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(own) < K, F.size(own).cast("double")).otherwise((K - 1) / part)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of the distinct shingles of two texts that both hold."""
    least = union_sketch(a, b)
    both = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(both / F.size(least))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the distinct shingles of ``a`` that ``b`` holds too; 1 where ``a`` has none."""
    shared = resemblance(a, b) * distinct_shingles(union_sketch(a, b))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a)))


def rendered(own: Column) -> Column:
    """A sketch as text: base64 of its hashes, 8 bytes each."""
    digits = F.array_join(F.transform(own, lambda h: F.lpad(F.hex(h), 16, "0")), "")
    return F.translate(F.base64(F.unhex(digits)), "\r\n", "")


def sketches(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its ``sketch``."""
    return docs.withColumn("sketch", sketch(F.col("text")))


def merged(sketched: DataFrame, *groups: str) -> DataFrame:
    """One ``sketch`` for each group of ``sketched`` rows, over all their shingles."""
    rank = Window.partitionBy(*groups).orderBy("hash")
    return (
        sketched.select(*groups, F.explode_outer("sketch").alias("hash"))
        .distinct()
        .withColumn("at", F.row_number().over(rank))
        .where(F.col("at") <= K + 1)  # a group's null, from documents without shingles, may take a place
        .groupBy(*groups)
        .agg(F.slice(F.sort_array(F.collect_list("hash")), 1, K).alias("sketch"))
    )


def _neighbours(texts: DataFrame, staged: Staged) -> DataFrame:
    """For each distinct (doc_id, tie): the length of its tail to replace, and the id and tie of the next document."""
    own = texts.select("doc_id", "tie", F.floor(F.length("text") / 3).cast("int").alias("tail"))
    ids = ranked(own.groupBy("doc_id").agg(F.min("tie").alias("tie")), ("doc_id",), staged, "ids")
    last = ids.agg(F.max("rank")).first()[0]
    after = ids.select(F.col("doc_id").alias("next_id"), F.col("tie").alias("next_tie"), F.col("rank").alias("next_rank"))
    wanted = ids.withColumn("next_rank", F.when(F.col("rank") == 0, F.lit(last)).otherwise(F.col("rank") - 1))
    nexts = wanted.join(after, "next_rank").select("doc_id", "next_id", "next_tie")
    return staged.write(own.distinct().join(nexts, "doc_id"), "nexts")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Of each document: the edited text, both sketches, and how alike they and the next document's are.

    The edited text has the last third of the code points replaced by as many
    of the start of the next document in descending order of id.
    """
    staged = Staged(docs.sparkSession, "fingerprints")
    text = F.coalesce("text", F.lit(""))
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    nexts = _neighbours(texts, staged)
    whole = texts.withColumn("sketch", sketch(F.col("text")))
    # both joins read the texts dealt by (doc_id, tie), so one shuffle of them serves both
    wanted = nexts.withColumnsRenamed({"doc_id": "own_id", "tie": "own_tie", "next_id": "doc_id", "next_tie": "tie"})
    start = F.substring("text", F.lit(1), F.col("tail")).alias("start")
    starts = (
        whole.join(wanted, ["doc_id", "tie"])
        .select(F.col("own_id").alias("doc_id"), F.col("own_tie").alias("tie"), "tail", start, F.col("sketch").alias("next_sketch"))
        .dropDuplicates(["doc_id", "tie"])
    )
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("tail"))
    edited = whole.join(starts, ["doc_id", "tie"]).withColumn("edited", F.concat(kept, "start"))
    return edited.withColumn("edited_sketch", sketch(F.col("edited"))).select(
        "doc_id", "text", "edited", "sketch", "edited_sketch", "next_sketch"
    )


def digest(compared: DataFrame) -> DataFrame:
    """The digest columns of ``compare_edited``."""
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return compared.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        rendered(own).alias("fingerprint"),
        rendered(edited).alias("edited_fingerprint"),
        resemblance(own, edited).alias("near_edited"),
        resemblance(own, after).alias("near_next"),
        containment(own, edited).alias("contained_edited"),
        distinct_shingles(own).alias("n_shingles"),
    )
