"""Whole-batch text work on Arrow buffers: words, word hashes and shingles without a Python loop over words.

A word is `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, on the UTF-8 bytes. Hashes are 64-bit polynomials over the bytes,
taken as differences of one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# A batch is worked on in pieces of about this many bytes of text; a longer text is a piece of its own.
PIECE_BYTES = 1_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit changes half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64, kept for the next call."""
    known = POWERS.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, PIECE_BYTES + 64), base, dtype=np.uint64)
        steps[0] = 1
        known = POWERS[int(base)] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


class Words(NamedTuple):
    """Words of some texts in order: text i has words first[i] to first[i + 1]; word w is data[start[w]:end[w]]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one entry more than texts). A null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `limit` bytes of text each; rows stay whole."""
    _, at = text_buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        stop = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
        stop = min(max(stop, begin + 1), batch.num_rows)
        yield batch.slice(begin, stop - begin)
        begin = stop


def split_words(texts: pa.Array) -> Words:
    data, at = text_buffers(texts)
    data = LOWER[data]
    filled = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.empty(len(data), dtype=bool)
    before[1:] = filled[:-1]
    before[:1] = False
    after = np.empty(len(data), dtype=bool)
    after[:-1] = filled[1:]
    after[-1:] = False
    start = np.flatnonzero(filled & (~before | edge[:-1]))
    end = np.flatnonzero(filled & (~after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, at))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end]."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(BASE, len(data)), dtype=np.uint64, out=total[1:])
    return mix((total[end] - total[start]) * powers(INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    return span_hashes(words.data, words.start, words.end)


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive values; as many as windows, none if there are fewer values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total *= BASE
        total += values[i : i + n]
    return mix(total)


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its `size`-word shingles.

    A text with fewer words has one element, its whole sequence; a text without words has none.
    """
    words = split_words(texts)
    hashes = word_hashes(words)
    windows = window_hashes(hashes, size)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for i in range(a, b):
                short = short * BASE + hashes[i]
            yield mix(short)
        else:
            yield np.zeros(0, np.uint64)


def word_text(words: Words, which: np.ndarray) -> pa.Array:
    """The chosen words as strings."""
    lengths = words.end[which] - words.start[which]
    offsets = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    source = np.repeat(words.start[which] - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.Array.from_buffers(
        pa.large_string(), len(which), [None, pa.py_buffer(offsets), pa.py_buffer(words.data[source])]
    ).cast(pa.string())
