"""Benchmark decontamination: pigeonhole edit matching.

Text is lower-cased, ASCII punctuation counts as blank and runs of blanks as
one. An item of m characters may differ by ``m // CHARS_PER_ERROR`` edits
(insertions, deletions, replacements) from a stretch of a document. It is cut
into one piece more than that budget: a stretch within the budget holds at
least one piece unchanged. All pieces of a block of items are found in one pass
over each whole text by an Aho-Corasick automaton; around each hit the whole
item is held against the text by Myers' bit-parallel distance.

Items are a query set against all documents, in blocks: a block has at most
``BLOCK_CHARS`` characters of items, which bounds what is gathered on the
driver and sent to the tasks; more items are more blocks. The pass shuffles
nothing, so hot sources and groups of copies cost no more than their rows.

An item of fewer than ``LEAST_CHARS`` normalised characters matches exactly: a
text that equals it or, with ``inside`` (as the query and the pipeline have it),
any text that holds it between words, found by the same automaton. Scripts that
put no blanks between words (``UNSPACED``) let an item start and end anywhere.
Parts of an item are not matched: a text with a long part of an item, but not
the whole within its budget, passes.

Defined results: null or empty texts and items match nothing; of a document's stretches the closest counts; repeated rows give repeated
results; rows without an id are ignored; an empty benchmark or table gives an
empty table; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_map

CHARS_PER_ERROR = 16
LEAST_CHARS = 24
BLOCK_CHARS = 4_000_000

SCHEMA = "doc_id long, item_id long, distance int, budget int"
#: Code points of scripts without blanks between words: Thai to Myanmar (without Tibetan), Khmer, CJK and kana.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_BLANK = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def normalised(text: str | None) -> str:
    return b" ".join((text or "").lower().encode().translate(_BLANK).split()).decode()


def _unspaced(c: str) -> bool:
    return any(a <= ord(c) <= b for a, b in UNSPACED)


def _apart(text: str, at: int) -> bool:
    """Whether a word may end before place ``at`` of a text."""
    if at <= 0 or at >= len(text):
        return True
    a, b = text[at - 1], text[at]
    return not (a.isalnum() and b.isalnum()) or _unspaced(a) or _unspaced(b)


def pieces(item: str) -> list[tuple[int, str]]:
    """Start and text of the pieces of an item: one more than its error budget, about equally long."""
    n = len(item) // CHARS_PER_ERROR + 1
    edges = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def myers(item: str, text: str) -> int:
    """Least edit distance of ``item`` to any stretch of ``text``, one bit per character of the item."""
    equal: dict[str, int] = {}
    for k, c in enumerate(item):
        equal[c] = equal.get(c, 0) | 1 << k
    every, top = (1 << len(item)) - 1, 1 << len(item) - 1
    up, down, score = every, 0, len(item)
    best = score
    for c in text:
        eq = equal.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        more = down | (~(xh | up) & every)
        less = up & xh
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            best = min(best, score)
        more, less = more << 1 & every, less << 1 & every
        up = less | (~(xv | more) & every)
        down = more & xv
    return best


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, str]], inside: bool = False):
        import ahocorasick

        self.long = [(k, t) for k, t in items if len(t) >= LEAST_CHARS]
        self.short: dict[str, list[int]] = {}
        for k, t in items:
            if 0 < len(t) < LEAST_CHARS:
                self.short.setdefault(t, []).append(k)
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(self.long):
            for start, piece in pieces(item):
                places.setdefault(piece, []).append((n, start + len(piece)))
        if inside:
            for item in self.short:
                places.setdefault(item, []).append((None, len(item)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()
        self.searched = bool(places)

    def find(self, text: str) -> dict[int, int]:
        """Distance of each item that is in a normalised text."""
        found = {k: 0 for k in self.short.get(text, ())}
        tried: set[tuple[int, int]] = set()
        if not self.searched:
            return found
        for end, where in self.automaton.iter(text):
            for n, piece_end in where:
                start = end + 1 - piece_end
                if n is None:
                    if _apart(text, start) and _apart(text, end + 1):
                        found.update(dict.fromkeys(self.short[text[start : end + 1]], 0))
                    continue
                if (n, start) in tried:
                    continue
                tried.add((n, start))
                k, item = self.long[n]
                if found.get(k) == 0:
                    continue
                budget = len(item) // CHARS_PER_ERROR
                if text.startswith(item, max(start, 0)):
                    found[k] = 0
                    continue
                stretch = text[max(0, start - budget) : max(0, start + len(item) + budget)]
                if len(stretch) < len(item) - budget:
                    continue
                distance = myers(item, stretch)
                if distance <= budget:
                    found[k] = min(distance, found.get(k, distance))
        return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, chars = [], 0
    rows = benchmark.where("item_id is not null and length(text) > 0").select("item_id", "text").orderBy("item_id")
    for r in rows.toLocalIterator():
        text = normalised(r.text)
        block.append((r.item_id, text))
        chars += len(text)
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, inside: bool = False) -> DataFrame:
    """doc_id, item_id, distance and error budget of every item found in a document; short items too with ``inside``."""
    spark = docs.sparkSession

    def scan(items: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, inside)
            budget = {k: len(t) // CHARS_PER_ERROR if len(t) >= LEAST_CHARS else 0 for k, t in shared.value}
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    rows += [(doc, k, d, budget[k]) for k, d in matcher.find(normalised(text.as_py())).items()]
                columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["doc_id", "item_id", "distance", "budget"],
                )

        own = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0))
        return own.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(arrow_map, run, SCHEMA)

    found = [scan(block) for block in _blocks(benchmark)]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], SCHEMA)
