"""Periodic runs of words by recursive frequency splitting and a lag scan of what survives.

A run is a stretch of words whose smallest period is q, at least ``LEAST_COPIES`` q
and ``LEAST_WORDS`` words long, that no neighbouring word extends.  Every word of a
run occurs in it once for each whole period.  So a word that is rarer than that in
a segment lies in no run there: it splits the segment, its parts are counted anew,
and so on until nothing changes.  Few words survive in running prose.  Surviving
segments are scanned lag by lag.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import text_or_empty

LEAST_WORDS = 6
LEAST_COPIES = 4

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

Run = tuple[int, int, int]


def surviving(codes: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Segments (from, to) in which every word occurs often enough; ``text`` says which words belong together."""
    place, segment = np.arange(len(codes)), text
    stable = [np.zeros((0, 2), np.int64)]
    width = int(codes.max(initial=0)) + 1
    while len(place):
        _, which, counts = np.unique(segment * width + codes[place], return_inverse=True, return_counts=True)
        often = counts[which] >= LEAST_COPIES
        # Segments without a rare word are done; the others are cut at theirs.
        cut = np.zeros(int(segment[-1]) + 1, bool)
        cut[segment[~often]] = True
        left = cut[segment]
        stable.append(_stretches(place[~left], segment[~left]))
        place, old = place[left & often], segment[left & often]
        if not len(place):
            break
        parts = _stretches(place, old)
        parts = parts[parts[:, 1] - parts[:, 0] >= LEAST_WORDS]
        sizes = parts[:, 1] - parts[:, 0]
        segment = np.repeat(np.arange(len(parts)), sizes)
        place = np.arange(sizes.sum()) + np.repeat(parts[:, 0] - (np.cumsum(sizes) - sizes), sizes)
    found = np.concatenate(stable)
    return [(a, b) for a, b in found[np.argsort(found[:, 0])].tolist() if b - a >= LEAST_WORDS]


def _stretches(place: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Consecutive places of one segment as ranges."""
    if not len(place):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(segment) != 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(place)])) - 1
    return np.stack([place[first], place[last] + 1], axis=1)


def _same_from(codes: np.ndarray, i: int, q: int) -> int:
    """The first place from ``i`` on that differs from the one ``q`` later, or where that one would be the end."""
    step, last = 64, len(codes) - q
    while i < last:
        to = min(i + step, last)
        differ = np.flatnonzero(codes[i:to] != codes[i + q:to + q])
        if len(differ):
            return i + int(differ[0])
        i, step = to, 2 * step
    return last


def _same_before(codes: np.ndarray, i: int, q: int) -> int:
    """The first place of the stretch up to ``i`` in which every place equals the one ``q`` later."""
    step = 64
    while i > 0:
        at = max(0, i - step)
        differ = np.flatnonzero(codes[at:i] != codes[at + q:i + q])
        if len(differ):
            return at + int(differ[-1]) + 1
        i, step = at, 2 * step
    return 0


def scan(codes: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a segment, by start, then period.

    For a lag q the segment is cut into blocks of q words.  A run of that period
    holds three whole blocks at least, which are equal, so only equal neighbours
    are looked at word by word: all lags together take n log n block hashes.
    Hashes only choose what is compared.  A stretch that a shorter lag has given
    already is a run of that lag.
    """
    n = len(codes)
    value = ta.mix(codes.astype(np.uint64) + np.uint64(1))
    powers, inverse = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, b, np.uint64)))) for b in (_BASE, _INVERSE))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(value * powers[:-1], dtype=np.uint64)))
    found: list[Run] = []
    by_start: list[Run] = []
    for q in range(1, n // LEAST_COPIES + 1):
        at = sums[::q]
        blocks = (at[1:] - at[:-1]) * inverse[:n:q][:len(at) - 1]
        equal = blocks[1:] == blocks[:-1]
        done = 0
        for k in np.flatnonzero(equal[1:] & equal[:-1]).tolist():
            i = k * q
            if i < done:
                continue
            near = by_start[:bisect.bisect_right(by_start, (i, n, n))]
            inside = next((r for r in reversed(near) if q % r[2] == 0 and i + 3 * q <= r[0] + r[1]), None)
            if inside:
                done = inside[0] + inside[1] - 3 * q + 1
                continue
            if (codes[i:i + 2 * q] != codes[i + q:i + 3 * q]).any():
                continue
            start, end = _same_before(codes, i, q), _same_from(codes, i + 2 * q, q) + q
            done = end - 3 * q + 1
            if end - start >= max(LEAST_WORDS, LEAST_COPIES * q):
                run = (start, end - start, q)
                found.append(run)
                bisect.insort(by_start, run)
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(words: list[list[bytes]]) -> list[list[Run]]:
    """The runs of every text, given as its words; all texts are split together."""
    sizes = np.array([len(w) for w in words], np.int64)
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for some in words for w in some), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in words]
    for a, b in surviving(codes, np.repeat(np.arange(len(words)), sizes)):
        which = bisect.bisect_right(first, a) - 1
        found[which] += [(a - int(first[which]) + s, n, q) for s, n, q in scan(codes[a:b])]
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that any run repeats, that is all after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


_RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
                       T.StructField("collapsed", T.StringType())])


def with_runs(docs: DataFrame, text_column: str = "text", name: str = "repeated") -> DataFrame:
    """Adds the struct ``name``: ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what white space (0x20, 0x09-0x0D) separates, numbered from 0.
    ``collapsed`` is the text with each run cut to its first period, its words
    joined by one space.  Null and empty texts have no words, no runs and an empty
    ``collapsed``.  Rows are independent of each other: repeated rows get the same
    result each, an empty table none, and other columns are kept as they are; one
    called ``name`` is replaced.  Texts are worked off in slices, a very long one
    alone.
    """
    def compute(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            n, starts, lengths, periods, bounds, texts = [], [], [], [], [0], []
            for part, _ in ta.slices(pa.record_batch({"text": array})):
                words = [x.encode().split() for x in part.column("text").to_pylist()]
                for w, runs in zip(words, runs_of(words), strict=True):
                    n.append(len(w))
                    for run in runs:
                        for column, value in zip((starts, lengths, periods), run, strict=True):
                            column.append(value)
                    bounds.append(len(starts))
                    texts.append(collapsed(w, runs).decode())
            runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (starts, lengths, periods)], list(_RUN.names))
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs), pa.array(texts, pa.string())],
                list(_FOUND.names))

    return docs.withColumn(name, F.arrow_udf(compute, _FOUND, ArrowUDFType.SCALAR_ITER)(text_or_empty(text_column)))


def longest(runs: Column) -> Column:
    """The longest of ``runs`` (ties: smallest start, then period), null if there are none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("later"), (-r["period"]).alias("more"))))
    return F.when(best.isNotNull(), F.struct((-best["later"]).alias("start"), best["length"].alias("length"),
                                             (-best["more"]).alias("period")))
