"""BPE encoding and decoding with content-defined chunk reuse.

A text's bytes are cut into chunks where a rolling hash of the last eight
bytes meets a mask, so that equal passages of different documents give equal
chunks, wherever they stand. A chunk is encoded once per task and kept; later
documents take its ids from there.

A cut may fall inside a word. A chunk is therefore encoded only between its
first and its last blank (white space surely separates tokens of this kind of
vocabulary); its ragged ends stay text. The join of two chunks is repaired by
re-encoding the stretch from the last blank before the cut to the first blank
after it, over as many chunks as hold no blank. At blanks both sides agree
exactly, so the ids equal those of the whole text.

Within a chunk the unit is the piece that the tokenizer's splitting step makes
of the lower-cased text, such as a word or a row of marks: every distinct piece
is encoded once per task by the tokenizers library's model. A run between blanks
that holds a character outside ``LETTERS`` and ``MARKS``, on which the library's
normaliser or splitting could do more than that, or the start of an added token
goes to the library as it stands, also once per task.

Both caches are bounded; a full cache is emptied. A Python worker loads the
tokenizer once and encodes on the one thread of its task: the library keeps
memory for every tokenizer and thread that it has had, which would grow from task
to task. A text's ids are only joined, never cut, so whole texts are encoded. ``decode`` joins the tokens of
the ids as the library's decoder does for a tokenizer without a decoder step.

Defined results: a null or empty text has no ids and an empty decoded text;
repeated rows are encoded one by one; an empty table gives an empty table;
only doc_id and text are read. A tokenizer that has a post-processing, decoder
or normaliser step which reaches across blanks is refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.common import arrow_map
from tagloom.llm.wordhash import slices, text_buffers

VOCABULARY = "word_bpe_49k.json"
#: Chunks have 2**CHUNK_BITS bytes on average.
CHUNK_BITS = 9
#: Most chunks and units (pieces or whole runs) that a task keeps, about.
KEPT_CHUNKS = 8_000
KEPT_UNITS = 120_000
#: Bytes of text that are encoded at once, about; one text at least.
SLICE = 1 << 18
BLANKS = b" \t\n\x0b\x0c\r"
#: Letters beyond ASCII that compose with none of these and are lower-cased one by one, as ``str.lower`` does:
#: Latin-1, Latin Extended-A without dotted and dotless i, Cyrillic.
LETTERS = "\xc0-\xd6\xd8-\xf6\xf8-\xff\u0100-\u012f\u0132-\u017f\u0400-\u045f"
#: Dashes, quotes, bullets and dots.
MARKS = "\u2010-\u2027"
#: The splitting and normalising steps that ``_PIECES`` and ``str.lower`` stand for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^ \t-\ra-z0-9{LETTERS}]+")
_OTHER = re.compile(f"[^\\x00-\\x7f{LETTERS}{MARKS}]|<\\|")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabularies have the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def check_vocabulary(path: str) -> None:
    """Refuse a tokenizer whose ids may depend on text beyond a blank."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if set(steps) - {"NFC", "Replace", "Lowercase"} or splits != ["Split", "ByteLevel"] or spec["decoder"]:
        raise ValueError(f"{path}: this tokenizer may join text across blanks")
    if any(a["lstrip"] or a["rstrip"] or any(c.isspace() for c in a["content"]) for a in spec["added_tokens"]):
        raise ValueError(f"{path}: an added token takes blanks")


def cuts(data: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Places in ``data`` after which a chunk ends, never inside a character."""
    if len(data) < 9:
        return np.empty(0, np.int64)
    window = np.ndarray(len(data) - 8, "<u8", data, 0, (1,))
    hashed = window * np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero(hashed >> np.uint64(64 - bits) == 0) + 8
    return at[(data[at] & 0xC0) != 0x80]


@lru_cache(maxsize=1)
def plain_steps(path: str) -> bool:
    """Whether the tokenizer's steps are those that ``_PIECES`` and ``str.lower`` stand for."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split, to_bytes = spec["pre_tokenizer"]["pretokenizers"]
    return (
        (spec["normalizer"] or {}).get("normalizers") == _STEPS
        and (split["pattern"], split["behavior"], split["invert"]) == ({"Regex": _SPLIT}, "Removed", True)
        and not to_bytes["add_prefix_space"]
        and not to_bytes["use_regex"]
        and all(a["content"].startswith("<|") and not a["normalized"] for a in spec["added_tokens"])
    )


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary, where it is another than in Latin-1."""
    same = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in same)}


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer of a Python worker, whatever the number of its tasks."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Units(dict):
    """Ids as bytes, and the tokens' text with a blank before each, of the units met so far."""

    def __init__(self, path: str):
        self.tokenizer, self.plain = _tokenizer(path), plain_steps(path)
        self.tokenize = self.tokenizer.model.tokenize
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.text = [b""] * (max(vocabulary.values()) + 1)
        for text, k in vocabulary.items():
            self.text[k] = b" " + text.encode()
        self.ids = [k.to_bytes(4, "little") for k in range(len(self.text))]

    def split(self, text: bytes) -> list[str | bytes]:
        """Pieces of the text and, as bytes, the runs between blanks that the library must see as they stand."""
        if not self.plain:
            return text.split()
        whole = text.decode()
        if not _OTHER.search(whole):
            return _PIECES.findall(whole.lower())
        out = []
        for run in text.split():
            word = run.decode()
            if _OTHER.search(word):
                out.append(run)
            else:
                out += _PIECES.findall(word.lower())
        return out

    def __missing__(self, unit: str | bytes) -> tuple[bytes, bytes]:
        """Encode a unit that is not kept yet."""
        if len(self) > KEPT_UNITS:
            self.clear()
        if type(unit) is bytes:
            # one by one: a batch would go to a thread for each core of the machine
            ids = self.tokenizer.encode(unit.decode(), add_special_tokens=False).ids
        elif unit.isascii() and unit.isprintable():
            ids = [t.id for t in self.tokenize(unit)]
        else:
            ids = [t.id for t in self.tokenize(unit.encode().decode("latin-1").translate(_byte_letters()))]
        own = self[unit] = b"".join([self.ids[k] for k in ids]), b"".join([self.text[k] for k in ids])
        return own


class Encoder:
    """Ids and decoded bytes of texts, with the chunks and units of one task kept."""

    def __init__(self, path: str):
        self.units = Units(path)
        self.chunks: dict[bytes, tuple[bytes, tuple[bytes, bytes] | None, bytes]] = {}

    def encoded(self, text: bytes) -> tuple[bytes, bytes]:
        """Ids and decoded bytes, a blank before each token, of a text that begins and ends at blanks."""
        parts = list(map(self.units.__getitem__, self.units.split(text)))
        return b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])

    def chunk(self, chunk: bytes) -> tuple[bytes, tuple[bytes, bytes] | None, bytes]:
        """Ragged head, ids and decoded bytes of the inner part (None without a blank), ragged tail."""
        kept = self.chunks.get(chunk)
        if kept is None:
            if len(self.chunks) > KEPT_CHUNKS:
                self.chunks.clear()
            head, inner, tail = ragged(chunk)
            kept = self.chunks[chunk] = head, None if inner is None else self.encoded(inner), tail
        return kept

    def texts(self, texts: Iterable[list[bytes]]) -> Iterator[tuple[bytes, bytes]]:
        """Ids (little-endian, 4 bytes each) and decoded bytes of each text, given as its chunks."""
        for chunks in texts:
            parts, pending = [], []
            for c in chunks:
                head, inner, tail = self.chunk(c)
                pending.append(head)
                if inner is not None:
                    parts += self.encoded(b"".join(pending)), inner
                    pending = [tail]
            parts.append(self.encoded(b"".join(pending)))
            yield b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])[1:]


def ragged(chunk: bytes) -> tuple[bytes, bytes | None, bytes]:
    """A chunk's text before its first blank, from there to its last blank, and after that."""
    places = [p for p in map(chunk.find, _EACH_BLANK) if p >= 0]
    if not places:
        return chunk, None, b""
    first, last = min(places), max(map(chunk.rfind, _EACH_BLANK))
    return chunk[:first], chunk[first:last], chunk[last:]


_EACH_BLANK = [bytes([b]) for b in BLANKS]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                data, offsets = text_buffers(batch.column("text"))
                start, stop = int(offsets[0]), int(offsets[-1])
                ends = cuts(data[start:stop]) + start
                texts = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    inner = ends[np.searchsorted(ends, a, "right") : np.searchsorted(ends, b)].tolist()
                    edges = [a, *inner, b]
                    texts.append([data[x:y].tobytes() for x, y in zip(edges[:-1], edges[1:], strict=True)])
                n, ids_hash, text_hash = [], [], []
                for ids, decoded in encoder.texts(texts):
                    n.append(len(ids) // 4)
                    ids_hash.append(hashlib.sha256(ids).hexdigest())
                    text_hash.append(hashlib.sha256(decoded).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token count and hashes of ids and decoded text of each row of ``docs``."""
    path = path or vocabulary_path()
    check_vocabulary(path)
    return docs.select("doc_id", "text").transform(arrow_map, _encoded(path), SCHEMA)
