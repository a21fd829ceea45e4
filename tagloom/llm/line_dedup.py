"""Line dedup across documents (native: DataFrame functions only).

Every text is split at ``\\n``. A line's key is the line without
``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Keys of at least
``min_chars`` code points that stand in at least ``min_docs`` documents lose
all their lines, except in the largest document id that holds them. The other
lines stay and are joined by ``\\n`` in their order.

Only 128-bit key hashes are exploded and shuffled. Documents are counted with
partial aggregation, so a line that a third of all documents hold arrives as
one row per map task. The hashes found in enough documents are a written table,
so that both sides of the join that finds the places of dropped lines are plain
shuffles, of which Spark splits hot keys at run time.

Defined results: a null or empty text is one empty line; a text that loses all
lines becomes empty; rows without an id are returned unchanged and count as no
document; repeated rows with one id count as one document and each row is
treated alike; an empty table gives an empty table. Extra columns are kept
only if named in ``carry``; columns named like the results are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import Staged, ascii_lower

MIN_DOCS = 3
MIN_CHARS = 20
BLANKS = " \t\n\u000b\f\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _key_hashes(text: Column, min_chars: int) -> Column:
    """Position and 128-bit key hash of each line that is long enough."""

    def entry(line: Column, at: Column) -> Column:
        key = line_key(line)
        long_enough = (F.length(line) >= min_chars) & (F.length(F.btrim(line, F.lit(BLANKS))) >= min_chars)
        return F.when(
            long_enough,
            F.struct(at.alias("at"), F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")),
        )

    return F.filter(F.transform(lines_of(text), entry), lambda e: e.isNotNull())


def dedup_lines(
    docs: DataFrame, carry: tuple[str, ...] = (), min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``doc_id``, the columns of ``carry``, ``n_lines``, ``n_dropped`` and the ``kept`` text of each row of ``docs``."""
    text = F.col("text")
    row = (F.xxhash64(text), F.xxhash64(F.lit(1), text))
    entries = (
        docs.where(F.col("doc_id").isNotNull() & (F.length(text) >= min_chars))
        .select("doc_id", row[0].alias("_row_h1"), row[1].alias("_row_h2"), F.explode(_key_hashes(text, min_chars)).alias("e"))
        .select("doc_id", "_row_h1", "_row_h2", "e.*")
    )
    found = (
        entries.select("h1", "h2", "doc_id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .drop("n")
    )
    common = Staged(docs.sparkSession, "lines").write(found, "common")
    drops = (
        entries.join(common, ["h1", "h2"])
        .where(F.col("doc_id") < F.col("keeper"))
        .groupBy(F.col("doc_id").alias("_row_id"), "_row_h1", "_row_h2")
        .agg(F.collect_set("at").alias("_drops"))
    )
    kept_columns = ("doc_id", "text", *(c for c in carry if c not in ("doc_id", "text")))
    base = docs.select(
        *kept_columns, F.col("doc_id").alias("_row_id"), row[0].alias("_row_h1"), row[1].alias("_row_h2")
    )
    lines = lines_of(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))
    return (
        base.join(drops, ["_row_id", "_row_h1", "_row_h2"], "left")
        .withColumn("_lines", lines)
        .select(
            "doc_id",
            *carry,
            F.size("_lines").cast("long").alias("n_lines"),
            F.when(F.col("_drops").isNull(), 0).otherwise(F.size("_drops")).cast("long").alias("n_dropped"),
            F.when(F.col("_drops").isNull(), F.coalesce("text", F.lit("")))
            .otherwise(F.array_join(F.transform(left, lambda i: F.col("_lines")[i]), "\n"))
            .alias("kept"),
        )
    )
