"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Word n-grams of the test items that chance would rarely bring about seed candidate
places; there the item is aligned with the document's words, so that edited and
paraphrased copies score by what they still share in order.  All work on a text is
done where the text is: only counts of the items' own words are shuffled, in one
pass whatever the number of items.

A word is a run of letters and digits; in scripts without blanks between words every
character is one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import carried, text_or_empty, written

# Bytes of item text that are held by every task at a time; more items are worked off in blocks.
BLOCK_BYTES = 8 * 2**20
_PAIRS_AT_ONCE = 64
# Words are looked up in the bitmap of all items' words by as many bits of their hashes: half a megabyte.
_WORD_BITS = 22
# Distinct words a task counts before it hands them on.
_COUNTED_AT_ONCE = 2_000_000
# First bytes in UTF-8 of characters that are words of their own: kana and Han from U+3000 on,
# compatibility forms and all beyond U+FFFF; by their first byte and a range of the second, Thai
# and Lao, Myanmar, Khmer.
_OWN_LEADS = (0xE3, 0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9, 0xEF, 0xF0, 0xF1, 0xF2, 0xF3, 0xF4)
_OWN_PAIRS = ((0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F))


@dataclass(frozen=True)
class Settings:
    """Words of a seed, alignment scores, and the share of an item's words that a copy has to score."""

    seed_words: int = 3
    mismatch: float = -0.5
    gap: float = -0.5
    min_score: float = 0.45
    # An n-gram is rare, and a seed, if chance would bring it about no oftener in a document;
    # of an item without so many, those that come nearest are seeds.
    chance: float = 1e-3
    least_seeds: int = 8


class Items(NamedTuple):
    """Test items as word hashes, and a sorted index of n-gram, item and place.

    ``widths`` are the lengths of the n-grams; those marked ``whole`` count only in
    texts that have no other words.
    """

    ids: list[Any]
    hashes: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    whole: np.ndarray
    widths: tuple[int, ...]


class Match(NamedTuple):
    """An item's best alignment in a text: score per item word, and the words of the text that were searched."""

    item: int
    score: float
    start: int
    end: int


def _words(data: np.ndarray, t: ta.Texts) -> ta.Words:
    """Runs of letters and digits, cut around the characters that are words of their own."""
    w = ta.words(t, letters_only=True)
    leads = np.flatnonzero(data >= 0xE0)
    if not len(leads):
        return w
    lead, second = data[leads], data[np.minimum(leads + 1, len(data) - 1)]
    own = np.isin(lead, _OWN_LEADS)
    for first, low, high in _OWN_PAIRS:
        own |= (lead == first) & (second >= low) & (second <= high)
    at = leads[own]
    start = np.unique(np.concatenate((w.start, at, at + np.where(data[at] >= 0xF0, 4, 3))))
    run = np.searchsorted(w.start, start, side="right") - 1
    inside = start < w.end[run]
    start, run = start[inside], run[inside]
    end = np.minimum(np.append(start[1:], len(data)), w.end[run])
    return ta.Words(start, end, np.searchsorted(start, t.bounds))


def _word_hashes(t: ta.Texts) -> tuple[np.ndarray, np.ndarray]:
    data = ta.lower(t.data)
    w = _words(data, t)
    return ta.word_hashes(data, w), w.bounds


def _grams(h: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams within one text, and the word each begins with."""
    ok = ta.within(bounds, width)
    return ta.gram_hashes(h, tuple(range(width)))[ok], np.flatnonzero(ok)


def make_items(rows: list[tuple[Any, str | None]], width: int) -> Items:
    """Items with fewer words than ``width`` have themselves as their only n-gram; those without words match nothing."""
    h, bounds = _word_hashes(ta.texts(pa.array([x for _, x in rows], pa.string())))
    size = np.diff(bounds)
    grams, item, place, widths = [], [], [], []
    for w in range(1, width + 1):
        gram, first = _grams(h, bounds, w)
        of = np.searchsorted(bounds, first, side="right") - 1
        kept = size[of] == w if w < width else np.ones(len(of), bool)
        if kept.any():
            grams.append(gram[kept])
            item.append(of[kept])
            place.append((first - bounds[of])[kept])
            widths.append(w)
    if not widths:
        none = np.zeros(0, np.int64)
        return Items([i for i, _ in rows], h, bounds, none.view(np.uint64), none, none, none.astype(bool), ())
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")
    return Items([i for i, _ in rows], h, bounds, every[order], np.concatenate(item)[order], np.concatenate(place)[order],
                 np.zeros(len(order), bool), tuple(widths))


class _Filter:
    """Exact membership among sorted hashes, behind a bitmap of their lowest bits."""

    def __init__(self, grams: np.ndarray, bits: int = 20):
        self.grams = np.unique(grams)
        self.mask = np.uint64(2 ** bits - 1)
        self.seen = np.zeros(2 ** bits, bool)
        self.seen[(self.grams & self.mask).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``grams`` are members, and the member each is."""
        maybe = np.flatnonzero(self.seen[(grams & self.mask).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.grams, grams[maybe]), max(0, len(self.grams) - 1))
        if not len(self.grams):
            return maybe[:0], at[:0]
        same = self.grams[at] == grams[maybe]
        return maybe[same], at[same]


def rare_seeds(items: Items, counts: np.ndarray, total: int, docs: int, s: Settings) -> Items:
    """The index cut to rare n-grams; ``counts`` is of the items' distinct words, in order, among ``total`` of ``docs``.

    How often chance would bring an n-gram about follows from its words' own
    frequencies.  Its frequency as a whole would not do: copies of an item are
    what makes its n-grams frequent.  An item shorter than a seed is found within
    other words only if it is rare and has two words or more; otherwise a text has
    to be the item and nothing else.
    """
    if not len(items.grams):
        return items
    share = counts[np.searchsorted(np.unique(items.hashes), items.hashes)] / max(1, total)
    first = items.bounds[items.item] + items.place
    words = np.minimum(np.diff(items.bounds)[items.item], s.seed_words)
    expected = np.full(len(first), total / max(1, docs))
    for k in range(s.seed_words):
        expected *= np.where(k < words, share[np.minimum(first + k, len(share) - 1)], 1.0)
    order = np.lexsort((items.place, expected, items.item))
    per_item = np.bincount(items.item, minlength=len(items.ids))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(per_item) - per_item, per_item)
    chosen = np.sort(order[(expected[order] <= s.chance) | (rank < s.least_seeds)])
    whole = (words < s.seed_words) & ((words < 2) | (expected > s.chance))
    return items._replace(grams=items.grams[chosen], item=items.item[chosen], place=items.place[chosen],
                          whole=whole[chosen])


def align(pairs: list[tuple[np.ndarray, np.ndarray]], s: Settings) -> np.ndarray:
    """Best local alignment score of each (item, window) pair of word hashes; a matching word scores 1."""
    out = np.zeros(len(pairs))
    for a in range(0, len(pairs), _PAIRS_AT_ONCE):
        some = pairs[a:a + _PAIRS_AT_ONCE]
        rows, width = max(len(i) for i, _ in some), max(len(w) for _, w in some)
        item = np.zeros((len(some), rows), np.uint64)
        window = np.ones((len(some), width), np.uint64)
        for k, (i, w) in enumerate(some):
            item[k, :len(i)] = i
            window[k, :len(w)] = w
        slope = -s.gap * np.arange(width, dtype=np.float32)
        previous = np.zeros((len(some), width + 1), np.float32)
        best = np.zeros(len(some), np.float32)
        for r in range(rows):
            step = np.where(item[:, r, None] == window, np.float32(1), np.float32(s.mismatch))
            score = np.maximum(np.maximum(previous[:, :-1] + step, previous[:, 1:] + np.float32(s.gap)), 0)
            # Gaps in the item: the best earlier score less its distance.
            score = np.maximum.accumulate(score + slope, axis=1) - slope
            best = np.maximum(best, score.max(axis=1, initial=0))
            previous[:, 1:] = score
        out[a:a + len(some)] = best
    return out


def find(t: ta.Texts, items: Items, index: _Filter, s: Settings) -> list[list[Match]]:
    """For each text, the items that score ``min_score`` or more of their words.

    Seeds of one item whose places imply starts less than an item's length apart
    are searched together, with half an item's length on either side.
    """
    found: list[list[Match]] = [[] for _ in range(len(t))]
    h, bounds = _word_hashes(t)
    at, members = [], []
    for width in items.widths:
        grams, first = _grams(h, bounds, width)
        which, member = index.hits(grams)
        at.append(first[which])
        members.append(member)
    if not sum(map(len, at)):
        return found
    hit, member = np.concatenate(at), np.concatenate(members)
    lo = np.searchsorted(items.grams, index.grams[member], side="left")
    n = np.searchsorted(items.grams, index.grams[member], side="right") - lo
    entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = np.repeat(hit, n)
    text = np.searchsorted(bounds, word, side="right") - 1
    fits = ~items.whole[entry] | (np.diff(bounds)[text] == np.diff(items.bounds)[items.item[entry]])
    entry, word, text = entry[fits], word[fits], text[fits]
    if not len(entry):
        return found
    item, start = items.item[entry], word - items.place[entry]
    order = np.lexsort((start, item, text))
    text, item, start = text[order], item[order], start[order]
    size = np.diff(items.bounds)[item]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] >= size[1:])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(order)) - 1
    text, item, size = text[begin], item[begin], size[begin]
    a = np.maximum(bounds[text], start[begin] - size // 2)
    b = np.minimum(bounds[text + 1], start[end] + size + size // 2)
    for at in range(0, len(begin), 4096):
        some = range(at, min(len(begin), at + 4096))
        scores = align([(items.hashes[items.bounds[item[k]]:items.bounds[item[k] + 1]], h[a[k]:b[k]]) for k in some], s)
        for k, score in zip(some, scores / size[at:at + 4096], strict=True):
            if score >= s.min_score:
                base = bounds[text[k]]
                found[text[k]].append(Match(int(item[k]), float(score), int(a[k] - base), int(b[k] - base)))
    return [_best(m) for m in found]


def _best(matches: list[Match]) -> list[Match]:
    best: dict[int, Match] = {}
    for m in matches:
        if m.item not in best or m.score > best[m.item].score:
            best[m.item] = m
    return list(best.values())


def item_table(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> tuple[DataFrame, int]:
    """``id``, ``text`` and ``block`` of the distinct items, and how many blocks of about ``BLOCK_BYTES`` they make."""
    items = written(benchmark.select(F.col(item_column).alias("id"), text_or_empty(text_column).alias("text")).distinct(),
                    "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    return items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))), blocks


def _item_words(items: DataFrame) -> DataFrame:
    """``block`` and ``word`` (the hash as a long), once for each block."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, t in ta.slices(batch):
                h, bounds = _word_hashes(t)
                block = np.repeat(part.column("block").to_numpy(), np.diff(bounds))
                yield pa.record_batch({"block": pa.array(block), "word": pa.array(h.view(np.int64))})

    return items.select("block", "text").mapInArrow(hashes, "block long, word long").distinct()


def frequencies(docs: DataFrame, items: DataFrame, text_column: str = "text") -> tuple[DataFrame, int, int]:
    """``block``, ``word`` and ``n``, its occurrences among all documents, of the items' words; all words; documents.

    One pass over the documents serves all blocks.  Tasks count the words that a
    bitmap of a fixed size lets through; what it lets through by mistake falls out
    of the join with the items' words.
    """
    words = written(_item_words(items), "item-words")
    low = F.col("word").bitwiseAND(F.lit(2 ** _WORD_BITS - 1)) + 1
    bits = words.groupBy(F.bitmap_bucket_number(low).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(low)).alias("bits")).collect()
    sent = docs.sparkSession.sparkContext.broadcast([(r.bucket, bytes(r.bits)) for r in bits])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(2 ** _WORD_BITS, bool)
        for bucket, some in sent.value:
            unpacked = np.unpackbits(np.frombuffer(some, np.uint8), bitorder="little")
            start = (bucket - 1) * len(unpacked)
            seen[start:start + len(unpacked)] = unpacked
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = rows = 0
        for batch in batches:
            rows += len(batch)
            for _, t in ta.slices(batch):
                h, _ = _word_hashes(t)
                total += len(h)
                new, n = np.unique(h[seen[(h & np.uint64(2 ** _WORD_BITS - 1)).astype(np.int64)]], return_counts=True)
                held, back = np.unique(np.concatenate((held, new)), return_inverse=True)
                counts = np.bincount(back, np.concatenate((counts, n)), len(held)).astype(np.int64)
                if len(held) > _COUNTED_AT_ONCE:
                    yield pa.record_batch({"word": pa.array(held.view(np.int64)), "n": pa.array(counts),
                                           "docs": pa.array(np.zeros(len(held), np.int64))})
                    held, counts = held[:0], counts[:0]
        yield pa.record_batch({"word": pa.array([None, *held.view(np.int64).tolist()], pa.int64()),
                               "n": pa.array([total, *counts.tolist()], pa.int64()),
                               "docs": pa.array([rows, *[0] * len(held)], pa.int64())})

    sums = written(docs.select(text_or_empty(text_column).alias("text")).mapInArrow(
        count, "word long, n long, docs long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    every = sums.filter(F.col("word").isNull()).select("n", "docs").first()
    counts = written(words.join(sums.filter(F.col("word").isNotNull()), "word").select("block", "word", "n"), "item-counts")
    return counts, every.n if every else 0, every.docs if every else 0


def item_blocks(items: DataFrame, blocks: int, counts: DataFrame, total: int, docs: int, s: Settings) -> Iterator[Items]:
    """The items with their seeds, a block of about ``BLOCK_BYTES`` at a time, so that no task holds more."""
    for k in range(blocks):
        rows = items.filter(F.col("block") == k).select("id", "text").collect()
        block = make_items(sorted(((r.id, r.text) for r in rows), key=lambda r: (r[0] is None, r)), s.seed_words)
        n = {r.word: r.n for r in counts.filter(F.col("block") == k).collect()}
        yield rare_seeds(block, np.array([n.get(w, 0) for w in np.unique(block.hashes).view(np.int64).tolist()], np.int64),
                         total, docs, s)


def with_matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), item_column: str = "item_id",
                 text_column: str = "text", name: str = "matches") -> DataFrame:
    """Adds an array of ``item_id``, ``score``, ``start`` and ``end`` (words searched) of the items a text copies.

    Null and empty texts, and items without words, match nothing; of items repeated
    with id and text one counts, those with ids of their own match each; without
    items every array is empty.  An item shorter than a seed matches a text that is
    that item, or holds it if its two words or more rarely meet by chance.  The
    documents are read once to count the items' words and once to align.
    """
    kind = benchmark.schema[item_column].dataType
    result = T.ArrayType(T.StructType([
        T.StructField("item_id", kind), T.StructField("score", T.DoubleType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    column = F.array().cast(result)
    items, blocks = item_table(benchmark, item_column)
    for seeds in item_blocks(items, blocks, *frequencies(docs, items, text_column), settings):
        sent = docs.sparkSession.sparkContext.broadcast(tuple(seeds))

        def matches(arrays: Iterator[pa.Array], sent=sent) -> Iterator[pa.Array]:
            from pyspark.sql.pandas.types import to_arrow_type

            own = Items(*sent.value)
            index = _Filter(own.grams)
            for array in arrays:
                out = [[{"item_id": own.ids[m.item], "score": m.score, "start": m.start, "end": m.end} for m in found]
                       for _, t in ta.slices(pa.record_batch({"text": array})) for found in find(t, own, index, settings)]
                yield pa.array(out, to_arrow_type(result))

        udf = F.arrow_udf(matches, result, ArrowUDFType.SCALAR_ITER)
        column = F.concat(column, udf(text_or_empty(text_column)))
    return docs.withColumn(name, column)


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id",
                 item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """One row for each document and item it copies: ids, ``score``, ``start``, ``end``."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    found = with_matches(rows, benchmark, settings, item_column, "text")
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id",
                      item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """The documents that copy no item, with the columns of ``docs``."""
    found = with_matches(carried(docs, id_column, text_column), benchmark, settings, item_column, "text")
    return found.filter(F.size("matches") == 0).select("row.*")
