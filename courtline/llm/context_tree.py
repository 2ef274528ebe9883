"""LM scoring by context-tree weighting over bytes.

The next byte is coded bit by bit; each of its 255 bit places has a context tree
over the bytes before.  Every node holds the zeros and ones that training saw, and
predicts by the Krichevsky-Trofimov estimate; a node's own estimate and its
children's are mixed by the weights that the training data gave them, so a
prediction blends all depths that training has seen for its context.

Counts are gathered and predictions are made per distinct pair of context and next
byte, never per place in a text: a block of documents first lists its distinct
pairs, these meet in the trees, dealt out by the two nearest bytes of context, and
the answers go back to the blocks.  No table of the model is held by every task,
but for the nodes of depth 0 and 1, of which there are at most 257 x 255.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import text_arrays as ta
from courtline.llm.common import remainder, text_or_empty, written

# Bytes of context.  A pair is one long: the context from the nearest byte on, then the next byte.
DEPTH = 5
# Bytes of text in a block, on average.
BLOCK_BYTES = 32 * 2**20
HELD_OUT = (7, 2)
SPACE, END = 0x20, 0x0A
_HALF = np.log(0.5)


class Tokens(NamedTuple):
    """Texts as bytes: every word and a space, then one end; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray
    words: np.ndarray
    word_bounds: np.ndarray


def tokens(t: ta.Texts) -> Tokens:
    """A-Z lower-cased words between white space; ``words`` are their hashes."""
    data = ta.lower(t.data)
    w = ta.words(t)
    size = w.end - w.start
    text = ta.owner(w.bounds)
    start = np.concatenate(([0], np.cumsum(size + 1)))[:-1] + text if len(size) else np.zeros(0, np.int64)
    per_text = np.concatenate(([0], np.cumsum(size + 1)))[w.bounds] + np.arange(len(t) + 1)
    out = np.full(per_text[-1], SPACE, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[within + np.repeat(start, size)] = data[within + np.repeat(w.start, size)]
    out[per_text[1:] - 1] = END
    return Tokens(out, per_text, ta.word_hashes(data, w), w.bounds)


def pairs(t: Tokens, depth: int = DEPTH) -> np.ndarray:
    """The pair at every byte; before a text's start stand ends."""
    n = len(t.data)
    starts = t.bounds[:-1]
    place = np.arange(n) - np.repeat(starts, np.diff(t.bounds))
    out = np.zeros(n, np.int64)
    padded = np.concatenate((np.full(depth, END, np.uint8), t.data)).astype(np.int64)
    for k in range(1, depth + 1):
        byte = padded[depth - k:depth - k + n]
        out = out << 8 | np.where(place >= k, byte, END)
    return out << 8 | t.data


def distinct(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(keys))) if counts is None else (
        np.add.reduceat(counts, first) if len(first) else counts)
    return keys[first], sums


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up by eight."""
    x = np.asarray(x, np.float64)
    shifted = x + 8
    series = 1 / (12 * shifted) - 1 / (360 * shifted ** 3) + 1 / (1260 * shifted ** 5)
    out = (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * np.log(2 * np.pi) + series
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    return out - np.log(product)


class Level(NamedTuple):
    """Nodes of one depth and bit place, sorted: counts, log weighted probability, weight of the own estimate."""

    nodes: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    own: np.ndarray


def grow(keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH, least: int = 2) -> list[list[Level]]:
    """``levels[d][l]`` for depths ``depth`` down to ``least`` of the trees that sorted pairs with counts make.

    A node of bit place l is named by its context, then the l bits before.
    """
    levels: list[list[Level]] = [[] for _ in range(depth + 1)]
    for d in range(depth, least - 1, -1):
        for l in range(8):
            named = keys >> (8 - l)
            bit = keys >> (7 - l) & 1
            first = np.flatnonzero(np.concatenate(([True], named[1:] != named[:-1]))) if len(named) else np.zeros(0, np.int64)
            nodes = named[first]
            ones = np.add.reduceat(counts * bit, first) if len(first) else counts
            total = np.add.reduceat(counts, first) if len(first) else counts
            kt = log_kt(total - ones, ones)
            if d == depth:
                weighted, own = kt, np.ones(len(nodes))
            else:
                child = levels[d + 1][l]
                parent = (child.nodes >> (l + 8)) << l | child.nodes & ((1 << l) - 1)
                below = np.bincount(np.searchsorted(nodes, parent), child.weighted, len(nodes))
                weighted = np.logaddexp(kt, below) + _HALF
                own = np.exp(kt + _HALF - weighted)
            levels[d].append(Level(nodes, total - ones, ones, weighted, own))
        keys, counts = distinct(keys >> 16 << 8 | keys & 255, counts)
    return levels


def mix(levels: list[list[Level]], asked: np.ndarray, top: np.ndarray, depth: int = DEPTH, least: int = 2) -> np.ndarray:
    """log10 probability of each asked pair's byte.

    ``top`` [257, 256, 3] holds the zeros, ones and own weight of the nodes of
    depth 1, by their byte, and of depth 0 in its last row.  Depths that training has
    not seen for a context take no part; where it has seen none, a bit has probability one half.
    """
    out = np.zeros(len(asked))
    nearest = asked >> 8 * depth & 255
    for l in range(8):
        bit = (asked >> (7 - l) & 1).astype(bool)
        p = np.full(len(asked), 0.5)
        deeper = np.zeros(len(asked), bool)
        for d in range(depth, -1, -1):
            if d >= least:
                level = levels[d][l]
                name = (asked >> 8 * (depth - d + 1)) << l | (asked & 255) >> (8 - l)
                at = np.minimum(np.searchsorted(level.nodes, name), max(0, len(level.nodes) - 1))
                seen = level.nodes[at] == name if len(level.nodes) else np.zeros(len(asked), bool)
                if not seen.any():
                    continue
                zeros, ones, own = level.zeros[at], level.ones[at], level.own[at]
            else:
                place = (1 << l) | (asked & 255) >> (8 - l)
                zeros, ones, own = top[nearest if d else 256, place].T
                seen = zeros + ones > 0
            estimate = (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)
            blended = np.where(deeper, own * estimate + (1 - own) * p, estimate)
            p = np.where(seen, blended, p)
            deeper |= seen
        out += np.log10(p)
    return out


def top_nodes(rows: list[tuple[int, int, int, int, float]]) -> np.ndarray:
    """The nodes of depth 0 and 1 from (byte, bit place, zeros, ones, log probability of the children)."""
    top = np.zeros((257, 256, 3))
    below = np.zeros(256)
    for byte, place, zeros, ones, children in rows:
        kt = float(log_kt(np.array(zeros), np.array(ones)))
        weighted = np.logaddexp(kt, children) + _HALF
        top[byte, place] = zeros, ones, np.exp(kt + _HALF - weighted)
        top[256, place, :2] += zeros, ones
        below[place] += weighted
    kt = log_kt(top[256, :, 0], top[256, :, 1])
    top[256, :, 2] = np.exp(kt - np.logaddexp(kt, below))
    return top


# Groups of the trees are the two nearest bytes; groups of word hashes follow on.
_WORDS = 2 ** 16
# Blocks whose lists are summed in one task.
_FAN_IN = 64
# Bytes of lists of one group that one task answers.
ANSWER_BYTES = 64 * 2**20


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, which compress well."""
    return np.diff(keys.view(np.uint64), prepend=np.uint64(0)).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint64))


def _runs(groups: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each group of a sorted array with its range."""
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if len(groups) else []
    for a, b in zip(first, [*first[1:], len(groups)], strict=True):
        yield int(groups[a]), int(a), int(b)


def _context_group(keys: np.ndarray, depth: int) -> np.ndarray:
    return (keys >> np.uint64(8 * (depth - 1))).astype(np.int64)


def _word_group(hashes: np.ndarray, bits: int) -> np.ndarray:
    return _WORDS + (hashes >> np.uint64(64 - bits)).astype(np.int64)


class _Lists:
    """Distinct keys with training counts, gathered slice by slice."""

    def __init__(self) -> None:
        self.keys = [np.zeros(0, np.uint64)]
        self.counts = [np.zeros(0, np.int64)]
        self.held = 0

    def add(self, keys: np.ndarray, trained: np.ndarray) -> None:
        for some, weight in ((keys[trained], 1), (keys[~trained], 0)):
            k, n = distinct(some)
            self.keys.append(k)
            self.counts.append(n * weight)
            self.held += len(k)
        if self.held > 4_000_000:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        k, n = distinct(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.held = [k], [n], 0
        return k, n


LISTED = "block long, group long, keys binary, counts binary"


def listed(blocks: DataFrame, depth: int, word_bits: int) -> DataFrame:
    """For every block and group, the distinct pairs or word hashes of its texts with their training counts."""
    def gather(key: tuple, table: pa.Table) -> pa.Table:
        contexts, words = _Lists(), _Lists()
        for batch in table.to_batches():
            for part, t in ta.slices(batch):
                k = tokens(t)
                trained = part.column("train").to_numpy(zero_copy_only=False)
                contexts.add(pairs(k, depth).view(np.uint64), np.repeat(trained, np.diff(k.bounds)))
                words.add(k.words, np.repeat(trained, np.diff(k.word_bounds)))
                words.add(np.zeros(len(trained), np.uint64), trained)
        out: dict[str, list] = {"group": [], "keys": [], "counts": []}
        for lists, group in ((contexts, lambda x: _context_group(x, depth)), (words, lambda x: _word_group(x, word_bits))):
            keys, counts = lists.merged()
            for g, a, b in _runs(group(keys)):
                out["group"].append(g)
                out["keys"].append(_packed(keys[a:b]))
                out["counts"].append(counts[a:b].tobytes())
        return pa.table({"block": pa.array([key[0].as_py()] * len(out["group"]), pa.int64()),
                         "group": pa.array(out["group"], pa.int64()), "keys": pa.array(out["keys"], pa.binary()),
                         "counts": pa.array(out["counts"], pa.binary())})

    return blocks.groupBy("block").applyInArrow(gather, LISTED)


def merged(lists: DataFrame, blocks: int) -> DataFrame:
    """``group``, ``keys`` and ``counts`` over all blocks: sums of at most ``_FAN_IN`` lists at a time, in rounds."""
    def add(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.zeros(0, np.uint64), *map(_unpacked, table.column("keys").to_pylist())]
        counts = [np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())]
        k, n = distinct(np.concatenate(keys), np.concatenate(counts))
        k, n = k[n > 0], n[n > 0]
        return pa.table({"block": pa.array([key[1].as_py()], pa.int64()), "group": pa.array([key[0].as_py()], pa.int64()),
                         "keys": pa.array([_packed(k)], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary())})

    while True:
        blocks = -(-blocks // _FAN_IN)
        lists = lists.withColumn("block", F.expr(f"block div {_FAN_IN}")).groupBy("group", "block").applyInArrow(add, LISTED)
        if blocks <= 1:
            return lists.select("group", "keys", "counts")
        lists = written(lists, "sums")


def _upper(model: DataFrame, depth: int) -> np.ndarray:
    """The nodes of depth 0 and 1, from sums over the groups: at most 256 x 255 rows reach the driver."""
    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("group", "keys", "counts")), strict=True):
                levels = grow(_unpacked(keys).view(np.int64), np.frombuffer(counts, np.int64), depth)[2]
                places = [(1 << l) | level.nodes & ((1 << l) - 1) for l, level in enumerate(levels)]
                yield pa.record_batch({
                    "byte": pa.array(np.full(sum(map(len, places)), group >> 8)), "place": pa.array(np.concatenate(places)),
                    **{name: pa.array(np.concatenate([getattr(x, name) for x in levels]))
                       for name in ("zeros", "ones", "weighted")}})

    sums = model.filter(F.col("group") < _WORDS).mapInArrow(
        climb, "byte long, place long, zeros long, ones long, weighted double").groupBy("byte", "place").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
    return top_nodes(sorted(tuple(r) for r in sums.collect()))


def answered(lists: DataFrame, model: DataFrame, top: np.ndarray, depth: int) -> DataFrame:
    """``lists`` with, instead of counts, the log10 probabilities of pairs and the corpus counts of words.

    A group's model is sent once, or to as many tasks as it takes for each to answer
    about ``ANSWER_BYTES`` of lists.  Only the groups of trees, at most 65,536, can
    need several: there are more groups of word hashes than blocks.
    """
    sent = lists.sparkSession.sparkContext.broadcast(top)
    large = lists.filter(F.col("group") < _WORDS).groupBy("group").agg(
        F.ceil(F.sum(F.octet_length("keys")) / F.lit(ANSWER_BYTES)).alias("salts")).filter("salts > 1")

    def dealt(df: DataFrame, salt) -> DataFrame:
        return df.join(F.broadcast(large), "group", "left").withColumn(
            "salt", salt(F.coalesce("salts", F.lit(1).cast("long")))).drop("salts")

    asked = dealt(lists.select("block", "group", "keys"), lambda n: F.pmod(F.xxhash64("block"), n))
    copies = dealt(model, lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))

    def answer(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
        group = key[0].as_py()
        known = _unpacked(model.column("keys")[0].as_py()) if len(model) else np.zeros(0, np.uint64)
        counts = np.frombuffer(model.column("counts")[0].as_py(), np.int64) if len(model) else np.zeros(0, np.int64)
        wanted = [_unpacked(x) for x in asked.column("keys").to_pylist()]
        every = np.unique(np.concatenate([np.zeros(0, np.uint64), *wanted]))
        if group < _WORDS:
            value = mix(grow(known.view(np.int64), counts, depth), every.view(np.int64), sent.value, depth)
        else:
            at = np.minimum(np.searchsorted(known, every), max(0, len(known) - 1))
            value = np.where(known[at] == every, counts[at], 0).astype(np.float64) if len(known) else np.zeros(len(every))
        return pa.table({
            "block": asked.column("block"), "group": pa.array([group] * len(asked), pa.int64()), "keys": asked.column("keys"),
            "values": pa.array([value[np.searchsorted(every, w)].tobytes() for w in wanted], pa.binary())})

    return asked.groupBy("group", "salt").cogroup(copies.groupBy("group", "salt")).applyInArrow(
        answer, "block long, group long, keys binary, values binary")


def _joined(column: pa.ChunkedArray, order: np.ndarray, kind: type, keys: bool) -> np.ndarray:
    """The arrays in a binary column, in ``order``, as one; ``keys`` are packed."""
    parts = [np.frombuffer(column[int(k)].as_buffer(), kind) for k in order]
    out = np.empty(sum(map(len, parts)), kind)
    at = 0
    for part in parts:
        some = out[at:at + len(part)]
        if keys:
            np.cumsum(part, out=some)
        else:
            some[:] = part
        at += len(part)
    return out


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of keys that are all there, looked up in sorted order."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted))
    out[order] = values[np.searchsorted(keys, wanted[order])]
    return out


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", train: str = "train",
          depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``bits_per_byte`` of every row.

    The boolean column ``train`` says which rows are learned from (null: not).
    ``score`` is the log10 probability of the text's tokens, coded as bytes, by the
    trees; ``bits_per_byte`` its code length over the bytes coded, which are the
    words', one for each word and the end; ``base_score`` is the log10 probability by
    a unigram model with one added to each count.  Rows are dealt out to blocks by
    their place in a written copy, so ids and texts may be null or repeated at will.
    Null texts are empty: one end.  Without any training row every bit has
    probability one half.  Repeated rows are scored each; an empty table gives no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"),
                       F.coalesce(F.col(train), F.lit(False)).alias("train"))
    rows = written(rows.withColumn("place", F.monotonically_increasing_id()), "texts")
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    word_bits = max(6, blocks.bit_length())
    rows = rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks))).drop("place")
    lists = written(listed(rows, depth, word_bits), "lists")
    model = written(merged(lists, blocks), "model")
    top = _upper(model, depth)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(x, np.int64) for x in batch.column("counts").to_pylist()]
            yield pa.record_batch({"n": pa.array([int(c.sum()) for c in counts], pa.int64()),
                                   "v": pa.array([len(c) for c in counts], pa.int64())})

    n, v = model.filter(F.col("group") >= _WORDS).mapInArrow(sizes, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n, v = n or 0, v or 0
    replies = answered(lists, model, top, depth)

    def evaluate(key: tuple, texts: pa.Table, replies: pa.Table) -> pa.Table:
        group = replies.column("group").to_numpy()
        order = np.argsort(group, kind="stable")
        of_pairs, of_words = np.split(order, [np.searchsorted(group[order], _WORDS)])
        pair_keys, word_keys = (_joined(replies.column("keys"), x, np.uint64, True) for x in (of_pairs, of_words))
        pair_values, word_values = (_joined(replies.column("values"), x, np.float64, False) for x in (of_pairs, of_words))
        end = float(_find(word_keys, word_values, np.zeros(1, np.uint64))[0]) if len(texts) else 0.0
        parts = []
        for batch in texts.to_batches():
            for part, t in ta.slices(batch):
                k = tokens(t)
                log = _find(pair_keys, pair_values, pairs(k, depth).view(np.uint64))
                counts = _find(word_keys, word_values, k.words)
                sums = np.concatenate(([0.0], np.cumsum(np.log10(counts + 1))))
                known = np.concatenate(([0], np.cumsum(counts > 0)))
                n_words = np.diff(k.word_bounds)
                base = sums[k.word_bounds[1:]] - sums[k.word_bounds[:-1]] + np.log10(end + 1) - (n_words + 1) * np.log10(n + v + 1)
                scores = np.add.reduceat(log, k.bounds[:-1])
                parts.append(pa.table({
                    "id": part.column("id"), "train": part.column("train"), "n_tokens": pa.array(n_words + 1),
                    "n_known": pa.array(known[k.word_bounds[1:]] - known[k.word_bounds[:-1]] + int(end > 0)),
                    "train_tokens": pa.array(np.full(len(t), n, np.int64)), "base_score": pa.array(base),
                    "score": pa.array(scores),
                    "bits_per_byte": pa.array(-scores * np.log2(10) / np.diff(k.bounds))}))
        return pa.concat_tables(parts) if parts else empty

    empty = pa.table({"id": pa.array([], _arrow(docs, id_column)), "train": pa.array([], pa.bool_()),
                      **{c: pa.array([], pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")},
                      **{c: pa.array([], pa.float64()) for c in ("base_score", "score", "bits_per_byte")}})
    return rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        evaluate, f"id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                  "bits_per_byte double")


def _arrow(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def training_rows(id_column: str = "doc_id"):
    """Rows that the registered query learns from."""
    modulus, held = HELD_OUT
    return remainder(id_column, modulus) != held
