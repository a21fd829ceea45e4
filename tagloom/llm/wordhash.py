"""Word hashes of Arrow text batches, computed on byte arrays with numpy.

A batch's text buffer is cut into segments that end between words. Within a
segment one running polynomial sum gives the hash of any byte range, so all
words of a segment are hashed at once without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes that are no ASCII white space: words as in ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: ASCII letters and digits, and all bytes of other characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_LOWER]


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@dataclass
class Words:
    """Words of one segment: document number and hash of each, in order."""

    doc: np.ndarray
    full: np.ndarray
    _sums: np.ndarray
    _start: np.ndarray
    _end: np.ndarray
    _down: np.ndarray

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def prefix(self, n: int) -> np.ndarray:
        """Hash of each word's first ``n`` bytes (of the word if shorter)."""
        return self.part(self._start, np.minimum(self._start + n, self._end))

    def suffix(self, n: int) -> np.ndarray:
        return self.part(np.maximum(self._end - n, self._start), self._end)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    return data, offsets


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> Iterator[Words]:
    """Hash the maximal runs of ``word_byte`` bytes of every document, A-Z lower-cased."""
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        end = min(at + SEGMENT, stop)
        if end < stop:
            end = _cut(data, offsets, word_byte, at, end)
        piece = data[at:end]
        is_word = word_byte[piece]
        before = np.empty_like(is_word)
        before[0] = False
        before[1:] = is_word[:-1]
        first, last = np.searchsorted(offsets, (at, end))
        edges = offsets[first:last] - at
        before[edges[edges < len(piece)]] = False
        start = np.flatnonzero(is_word & ~before)
        after = np.empty_like(is_word)
        after[-1] = False
        after[:-1] = is_word[1:]
        ends = edges[(edges > 0) & (edges <= len(piece))] - 1
        after[ends] = False
        stop_at = np.flatnonzero(is_word & ~after) + 1
        up, down = _powers(max(SEGMENT, len(piece)))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_codes()[piece] * up[: len(piece)], out=sums[1:])
        doc = np.searchsorted(offsets, start + at, side="right") - 1
        out = Words(doc, np.empty(0), sums, start, stop_at, down)
        out.full = out.part(start, stop_at)
        yield out
        at = end


def _cut(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray, at: int, end: int) -> int:
    """A place near ``end`` that lies in no word: after a byte of no word, or where a document ends."""
    gaps = np.flatnonzero(~word_byte[data[at:end]])
    here = at + int(gaps[-1]) + 1 if len(gaps) else at
    k = int(np.searchsorted(offsets, end, side="right")) - 1
    here = max(here, int(offsets[k]))
    if here > at:
        return here
    document_end = int(offsets[np.searchsorted(offsets, at, side="right")])
    while end < document_end:
        gaps = np.flatnonzero(~word_byte[data[end : min(end + SEGMENT, document_end)]])
        if len(gaps):
            return end + int(gaps[0])
        end = min(end + SEGMENT, document_end)
    return document_end


def document_words(column: pa.Array, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents of a batch in one array, and n + 1 offsets into it."""
    data, offsets = text_buffers(column)
    n = len(offsets) - 1
    doc, full = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for w in words(data, offsets, word_byte):
        doc.append(w.doc)
        full.append(w.full)
    counts = np.bincount(np.concatenate(doc), minlength=n)
    return np.concatenate(full), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose text has about ``most_bytes``; one row at least."""
    data, offsets = text_buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end
