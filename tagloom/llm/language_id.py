"""Language ID by cross-parsing entropy over suffix automata.

For each language a suffix automaton of labelled text is built. A text is
parsed from left to right into phrases, each the longest match from its start
on in the language's training text. The language that needs the fewest
phrases, each weighted by the logarithm of its training length as the cost of
pointing into it, wins.

Text is lower-cased and reduced to its letters, with one space between runs.
Training takes at most ``MOST_ROWS`` rows of each language from the training
fold that have letters, chosen by a hash of the id, of each the first
``MOST_ROW_CHARS`` characters of its letters, and ``TOTAL_CHARS`` characters over all languages in equal shares:
a bounded sample. Of more than ``MOST_LANGUAGES`` lang values those with the most
training rows are learnt (of equals by name), so each has at least 2,000 characters.
Letters beyond the ``SYMBOLS`` most frequent ones share
symbols by their code point, which bounds the automata's tables.

Whole texts are parsed. They are laid out in blocks of ``BLOCK`` symbols in
which phrases end, and all blocks of a batch step through all automata at
once, one symbol at a time, in numpy; a long text is many blocks.

Defined results: ``und`` with score 0 for null, empty and letterless texts,
and for all rows if nothing could be learnt; equal languages are decided by
name; repeated rows are judged one by one; an empty table gives an empty
table; rows without an id are judged, their held_out is null and they train
nothing; lang and extra columns don't enter a prediction.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_map, fold
from tagloom.llm.wordhash import slices

FOLDS, HELD_OUT = 4, 2
MOST_ROWS, MOST_ROW_CHARS, TOTAL_CHARS = 60, 2000, 96_000
MOST_LANGUAGES = 48
SYMBOLS = 96
BLOCK = 512
BLOCKS_AT_ONCE = 4096
UNKNOWN = "und"


def letters(text: Column) -> Column:
    """Lower-cased letters of a text, runs of anything else as one space."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "), F.lit(" "))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


@dataclass
class Model:
    names: list[str]
    own: dict[int, int]  # code point to symbol
    width: int
    start: np.ndarray  # of each language, times width
    step: np.ndarray  # next state times width; ~next where a phrase ended before the symbol
    cost: np.ndarray  # of a phrase, by language

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not hasattr(self, "_table"):
            table = (np.arange(0x110000) % (self.width - 1 - len(self.own)) + 1 + len(self.own)).astype(np.uint8)
            for point, symbol in self.own.items():
                table[point] = symbol
            self._table = table
        return self._table[points]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases that each text needs in each language, ``len(texts)`` by languages."""
        counts = np.zeros((len(texts), len(self.names)), np.int64)
        symbols = self.symbols("".join(texts))
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        sizes = np.diff(at)
        per = -(-sizes // BLOCK)
        doc = np.repeat(np.arange(len(texts)), per)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        first = at[doc] + within * BLOCK
        long = np.minimum(at[doc] + sizes[doc] - first, BLOCK)
        order = np.argsort(-long, kind="stable")
        for k in range(0, len(order), BLOCKS_AT_ONCE):
            rows = order[k : k + BLOCKS_AT_ONCE]
            found = self._parse(symbols, first[rows], long[rows])
            np.add.at(counts, doc[rows], found)
        return counts

    def _parse(self, symbols: np.ndarray, first: np.ndarray, long: np.ndarray) -> np.ndarray:
        """Phrases of blocks, the longest first."""
        state = np.repeat(self.start[None, :], len(first), axis=0)
        ended = np.ones(state.shape, np.int64)  # the last phrase of a block ends with it
        active = np.searchsorted(-long, -np.arange(long[0]), side="left")
        for t in range(int(long[0])):
            n = active[t]
            to = self.step[state[:n] + symbols[first[:n] + t].astype(np.int32)[:, None]]
            over = to < 0
            ended[:n] += over
            state[:n] = np.where(over, ~to, to)
        return ended


def _model(samples: dict[str, str]) -> Model | None:
    names = sorted(n for n, t in samples.items() if t)
    if not names:
        return None
    frequent = [c for c, _ in Counter("".join(samples[n] for n in names)).most_common(SYMBOLS)]
    own = {ord(c): k + 1 for k, c in enumerate(sorted(frequent))}
    width = len(own) + 9
    model = Model(names, own, width, np.zeros(len(names), np.int32), np.empty(0), np.empty(0))
    tables, base = [], 0
    for k, name in enumerate(names):
        moves = suffix_automaton(model.symbols(samples[name]).tolist())
        root = np.full(width, ~np.int64(base * width))
        for c, to in moves[0].items():
            root[c] = ~np.int64((base + to) * width)
        table = np.repeat(root[None, :], len(moves), axis=0)
        for state, row in enumerate(moves):
            for c, to in row.items():
                table[state, c] = (base + to) * width
        model.start[k] = base * width
        tables.append(table.astype(np.int32).ravel())
        base += len(moves)
    model.step = np.concatenate(tables)
    model.cost = np.log2(np.array([len(samples[n]) for n in names]) + 1.0)
    return model


def fit(docs: DataFrame) -> Model | None:
    """Automata of the languages, from the bounded sample of the training fold."""
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    training = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    counts = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    learnt = [r.lang for r in counts.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()]
    rows = (
        training.where(F.col("lang").isin(learnt))
        .select("lang", "doc_id", F.substring(letters(F.col("text")), 1, MOST_ROW_CHARS).alias("text"))
        .where(F.length("text") > 0)
        .withColumn("k", F.row_number().over(rank))
        .where(F.col("k") <= MOST_ROWS)
        .select("lang", "k", "text")
        .orderBy("lang", "k")
        .collect()
    )
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r.lang, []).append(r.text)
    share = TOTAL_CHARS // max(1, len(samples))
    return _model({name: " ".join(texts)[:share] for name, texts in samples.items()})


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs``.

    ``score`` is how much cheaper the best language is than the second, as a
    share of the second's cost; 1 where only one language is known.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                some = [k for k, t in enumerate(texts) if t]
                if model is not None and some:
                    cost = model.phrases([texts[k] for k in some]) * model.cost
                    best = cost.argmin(axis=1)
                    if len(model.names) > 1:
                        two = np.partition(cost, 1, axis=1)
                        share = (two[:, 1] - two[:, 0]) / two[:, 1]
                    else:
                        share = np.ones(len(some))
                    for k, b, s in zip(some, best, share, strict=True):
                        names[k], scores[k] = model.names[b], s
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    judged = docs.select("doc_id", letters(F.col("text")).alias("text")).transform(
        arrow_map, run, "doc_id long, lang_pred string, score double"
    )
    return judged.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
