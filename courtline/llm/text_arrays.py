"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.

Everything works on all texts of a slice at once, so the cost a byte does not
depend on how long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are turned into arrays at a time; a longer text comes alone.
SLICE_BYTES = 2**20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("0"):ord("9") + 1] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


class Texts(NamedTuple):
    """Bytes of some texts, one after the other; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


class Words(NamedTuple):
    """Words by start, end and text, in order; ``bounds`` are the words' texts as ranges."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def texts(column: pa.Array) -> Texts:
    """Texts of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return Texts(data, bounds - bounds[0])


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """A batch in runs of rows of about ``most`` bytes of text each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    group = (np.cumsum(sizes) - 1).clip(0) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
        if b > a:
            part = batch.slice(a, b - a)
            yield part, texts(part.column(column))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return _LOWER[data]


def words(t: Texts, letters_only: bool = False) -> Words:
    """Runs of bytes that are not white space (0x20, 0x09-0x0D); or of letters, digits and bytes from 0x80 on."""
    inside = np.zeros(len(t.data) + 2, bool)
    inside[1:-1] = _LETTER[lower(t.data)] if letters_only else ~_SPACE[t.data]
    begins = inside[1:] & ~inside[:-1]
    ends = ~inside[1:] & inside[:-1]
    # A word ends where its text does, even if the next text goes on at once.
    inner = t.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(t.data))]
    joined = inner[inside[inner] & inside[inner + 1]]
    begins[joined] = True
    ends[joined] = True
    start = np.flatnonzero(begins[:-1]) if len(t.data) else np.zeros(0, np.int64)
    end = np.flatnonzero(ends) if len(t.data) else np.zeros(0, np.int64)
    return Words(start, end, np.searchsorted(start, t.bounds))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes: polynomial sums from prefix sums, then mixed."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), _BASE)[:-1], out=sums[1:])
    inverse = _powers(len(data), _INVERSE)
    h = (sums[w.end] - sums[w.start]) * inverse[w.start]
    return mix(h + (w.end - w.start).astype(np.uint64))


def gram_hashes(h: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at ``offsets`` from each word; as long as ``h`` less the largest offset."""
    n = max(0, len(h) - max(offsets))
    out = np.full(n, np.uint64(len(offsets)), np.uint64)
    for k, o in enumerate(offsets):
        out = mix(out * _BASE + h[o:o + n] + np.uint64(k + 31 * o))
    return out


def owner(bounds: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def within(bounds: np.ndarray, width: int) -> np.ndarray:
    """Whether a window of ``width`` words from each word on ends in the same text."""
    text = owner(bounds)
    n = max(0, len(text) - width + 1)
    return text[:n] == text[width - 1:]
