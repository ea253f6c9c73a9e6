"""Words and lines of Arrow string columns as numpy arrays, without one Python object per word.

A word is a maximal run of bytes other than space and the control characters 9 to 13. As
UTF-8 never uses those bytes inside another character, bytes and characters agree on it.
Words are named by 64-bit hashes of their bytes, taken eight at a time, each mixed in before
the next: unlike sums and polynomials, which some regular words defeat, this has no structure
that texts meet by chance. Long stretches are hashed by BLAKE2.
"""

from __future__ import annotations

import hashlib
import sys
import types
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)

# Text is worked on in blocks of about this many bytes, which bounds the memory for
# arrays with one entry per byte; a block ends between two words.
BLOCK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
# Stretches of more bytes are hashed one by one.
LONG_BYTES = 128


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing step of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _process_memory() -> dict[str, dict]:
    """What lives as long as the Python process, whatever tasks it runs."""
    name = "_llm_process_memory"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("held", {})


def worker_cache(name: str) -> dict:
    """A dict that outlives the task; one at a time.

    Asking for another drops it, so that a worker which goes on to another operator does
    not keep the memory of the one before.
    """
    held = _process_memory().setdefault("cache", {})
    if name not in held:
        held.clear()
        held[name] = {}
    return held[name]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts (one more for the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1]
    starts = starts.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def slices(texts: pa.Array, most_bytes: int = 2 * BLOCK_BYTES):
    """Consecutive slices of about ``most_bytes`` each; a longer text is alone in its slice."""
    _, starts = text_bytes(texts)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(starts, starts[at] + most_bytes, "right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield texts.slice(at, end - at)
        at = end


@dataclass
class Spans:
    """Stretches of text: byte bounds, the text each belongs to, and a 64-bit hash."""

    begin: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    code: np.ndarray


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data``, which ``fold`` maps bytewise first."""
    sizes = (end - begin).astype(np.int64)
    codes = mix(sizes.astype(np.uint64) * BASE)
    if not len(codes):
        return codes
    folded = np.concatenate([fold[data], np.zeros(8, np.uint8)])
    # Eight bytes from every place on.
    eights = np.ndarray((len(folded) - 7,), "<u8", folded, strides=(1,))
    going = np.flatnonzero((sizes > 0) & (sizes <= LONG_BYTES))
    at = 0
    while len(going):
        chunk = eights[begin[going] + at]
        rest = sizes[going] - at
        last = rest < 8
        chunk[last] &= (np.uint64(1) << (rest[last].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        codes[going] = mix((codes[going] ^ chunk) * BASE + np.uint64(1))
        at += 8
        going = going[rest > 8]
    for i in np.flatnonzero(sizes > LONG_BYTES).tolist():
        digest = hashlib.blake2b(folded[begin[i] : end[i]], digest_size=8).digest()
        codes[i] = int.from_bytes(digest, "little")
    return codes


def word_spans(data: np.ndarray, starts: np.ndarray, fold: np.ndarray = LOWER) -> Spans:
    """All words of all texts in order; ``fold`` maps bytes first (``LOWER`` for A-Z)."""
    inside = ~SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Spans(none, none, none, np.zeros(0, np.uint64))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(starts) > 0)
    first, last = starts[filled], starts[filled + 1] - 1
    opens[first], closes[last] = inside[first], inside[last]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(starts, begin, "right") - 1
    return Spans(begin, end, doc, hash_spans(data, begin, end, fold))


def windows(spans: Spans, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a text: (code, doc, index of first word)."""
    if len(spans.code) < width:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    n = len(spans.code) - width + 1
    whole = np.flatnonzero(spans.doc[:n] == spans.doc[width - 1 :])
    code = np.full(len(whole), np.uint64(width))
    for k in range(width):
        code = mix(code * BASE + spans.code[whole + k])
    return code, spans.doc[whole], whole


def distinct(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, code) pairs, by doc and then code."""
    if len(doc) and np.any(doc[1:] < doc[:-1]):
        order = np.argsort(doc, kind="stable")
        code, doc = code[order], doc[order]
    code = code.copy()
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        code[a:b].sort()
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    return code[new], doc[new]


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words as (code, doc), by doc and then code.

    A text of fewer words has one shingle, its whole word sequence; one without words none.
    """
    data, starts = text_bytes(texts)
    spans = word_spans(data, starts)
    code, doc, _ = windows(spans, width)
    count = np.bincount(spans.doc, minlength=len(texts))
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.cumsum(count) - count
        own = count[short].astype(np.uint64)
        for k in range(width - 1):
            more = count[short] > k
            at = np.minimum(first[short] + k, len(spans.code) - 1)
            own = np.where(more, mix(own * BASE + spans.code[at]), own)
        code, doc = np.concatenate([code, own]), np.concatenate([doc, short])
    return distinct(code, doc)
