"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a common variant
within half the radius of both.  So every distinct fingerprint emits all its
variants of up to half the radius flipped bits, the variants are shuffled, and
fingerprints that meet in one are linked.

The variants are dealt out by the syndrome of a random linear code, which is
additive: the variants of a fingerprint that fall to one group follow from its own
syndrome and a small table of bit masks.  A fingerprint is therefore sent once to
a group, and its variants there are made on arrival.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import carried, look_up, text_or_empty, written
from courtline.llm.components import components

BITS = 64
RADIUS = 4
# Groups of the shuffle: at least 2**6, and so many that a group makes at most so many variants,
# and gets at most so many fingerprints, on average.
LEAST_RANK = 6
GROUP_VARIANTS = 128_000_000
GROUP_FINGERPRINTS = 16_000_000
# Variants that a group holds and sorts at a time.
SORTED_TOGETHER = 4_000_000


def shingle_hashes(t: ta.Texts, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every text's shingles of ``width`` words, A-Z lower-cased and joined by spaces; the texts' bounds.

    A text of fewer words has one shingle, all of them; one without words none.
    """
    data = ta.lower(t.data)
    w = ta.words(t)
    size = w.end - w.start
    start = np.concatenate(([0], np.cumsum(size + 1)))
    joined = np.full(start[-1], 0x20, np.uint8)
    at = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    joined[at] = data[at + np.repeat(w.start - start[:-1], size)]
    text = joined.tobytes()
    counts = np.diff(w.bounds)
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(shingles)))
    first = np.arange(bounds[-1]) + np.repeat(w.bounds[:-1] - bounds[:-1], shingles)
    last = first + np.repeat(np.minimum(counts, width), shingles) - 1
    digest = xxhash.xxh64_intdigest
    begins, ends = start[first].tolist(), (start[last + 1] - 1).tolist() if len(first) else []
    hashes = np.fromiter((digest(text[a:b], seed) for a, b in zip(begins, ends, strict=True)), np.uint64, len(begins))
    return hashes, bounds


def fingerprints(t: ta.Texts, width: int = 4, seed: int = 42) -> np.ndarray:
    """A bit is 1 if it is set in over half of a text's shingle hashes; zero without shingles."""
    hashes, bounds = shingle_hashes(t, width, seed)
    out = np.zeros((len(t), 64), bool)
    for i in range(len(t)):
        a, b = bounds[i], bounds[i + 1]
        counts = np.zeros(64, np.int64)
        for c in range(a, b, 65_536):
            bits = np.unpackbits(hashes[c:min(b, c + 65_536)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out[i] = 2 * counts > b - a
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def with_fingerprint(docs: DataFrame, text_column: str = "text", name: str = "fp", width: int = 4, seed: int = 42,
                     bits: int = BITS) -> DataFrame:
    """Adds the lowest ``bits`` bits of the fingerprint as a long."""
    mask = np.uint64(2 ** bits - 1)

    def compute(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            out = [fingerprints(t, width, seed) for _, t in ta.slices(pa.record_batch({"text": array}))]
            yield pa.array((np.concatenate([np.zeros(0, np.uint64), *out]) & mask).view(np.int64))

    return docs.withColumn(name, F.arrow_udf(compute, "long", ArrowUDFType.SCALAR_ITER)(text_or_empty(text_column)))


class Code:
    """A random linear code: syndromes of ``rank`` bits, and all masks of up to ``half`` bits by syndrome."""

    def __init__(self, rank: int, half: int, bits: int = BITS, seed: int = 17):
        self.columns = np.random.default_rng(seed).integers(0, 2 ** rank, bits, dtype=np.int64)
        masks, syndromes = [0], [0]
        for k in range(1, half + 1):
            for places in combinations(range(bits), k):
                masks.append(sum(1 << p for p in places))
                syndromes.append(int(np.bitwise_xor.reduce(self.columns[list(places)])))
        order = np.argsort(syndromes, kind="stable")
        found = np.array(syndromes, np.int64)[order]
        self.masks = np.array(masks, np.uint64)[order]
        self.syndromes, starts = np.unique(found, return_index=True)
        self.starts = np.append(starts, len(found))

    def syndrome(self, fp: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fp), np.int64)
        for i, c in enumerate(self.columns):
            out ^= np.where(fp >> np.uint64(i) & np.uint64(1), c, 0)
        return out


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all() and (root[a] == root[b]).all():
            break
    return root


def _meetings(fp: np.ndarray, kind: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in ``fp`` whose variants in this group meet, as a forest for each part of the variants.

    ``kind`` is each fingerprint's list of masks.  The variants are worked off in
    parts by a hash, so that only one part is held and sorted at a time.
    """
    sizes = np.diff(code.starts)
    passes = 1 << max(0, ceil(log2(max(1, sizes[kind].sum() / SORTED_TOGETHER))))
    shift = np.uint64(64 - passes.bit_length() + 1)
    members = [(np.flatnonzero(kind == k), code.masks[code.starts[k]:code.starts[k + 1]]) for k in np.unique(kind)]
    found_a, found_b = [], []
    for part in range(passes):
        made, maker = [], []
        for some, masks in members:
            for at in range(0, len(some), 100_000):
                rows = some[at:at + 100_000]
                v = (fp[rows][:, None] ^ masks[None, :]).reshape(-1)
                who = np.repeat(rows.astype(np.int32), len(masks))
                if passes > 1:
                    mine = (v * np.uint64(0x9E3779B97F4A7C15)) >> shift == part
                    v, who = v[mine], who[mine]
                made.append(v)
                maker.append(who)
        made, maker = np.concatenate(made), np.concatenate(maker)
        order = np.argsort(made, kind="stable")
        made = made[order]
        same = np.flatnonzero(made[1:] == made[:-1])
        a, b = maker[order[same]].astype(np.int64), maker[order[same + 1]].astype(np.int64)
        pairs = np.unique(np.minimum(a, b) * len(fp) + np.maximum(a, b))
        root = _forest(pairs // len(fp), pairs % len(fp), len(fp))
        child = np.flatnonzero(root != np.arange(len(fp)))
        found_a.append(child)
        found_b.append(root[child])
    return np.concatenate(found_a), np.concatenate(found_b)


def links(distinct: DataFrame, n: int, radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """Links (u, v) between the ``n`` distinct fingerprints of column ``fp``, enough to connect all within ``radius``.

    Fingerprints that meet in a variant lie within twice half the radius, so with
    an even radius every meeting is a link.  A group joins those that meet by a
    forest: never more rows than it has fingerprints, however dense they lie.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    half = radius // 2
    variants = sum(comb(bits, k) for k in range(half + 1))
    groups = n * variants / (GROUP_VARIANTS if n <= GROUP_FINGERPRINTS else GROUP_FINGERPRINTS)
    rank = max(LEAST_RANK, ceil(log2(max(1, groups))))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(rank, half, bits)
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            own = code.syndrome(fp.view(np.uint64))
            for s in code.syndromes:
                yield pa.record_batch({"q": pa.array(own ^ s), "fp": pa.array(fp)})

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        code = Code(rank, half, bits)
        fp = np.sort(table.column("fp").to_numpy().view(np.uint64))
        a, b = _meetings(fp, np.searchsorted(code.syndromes, code.syndrome(fp) ^ key[0].as_py()), code)
        root = _forest(a, b, len(fp))
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"u": pa.array(fp[child].view(np.int64)), "v": pa.array(fp[root[child]].view(np.int64))})

    dealt = distinct.select("fp").mapInArrow(emit, "q long, fp long")
    return dealt.groupBy("q").applyInArrow(meet, "u long, v long").distinct()


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4,
            seeds: tuple[int, ...] = (42,), radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """``id``, ``text_hash``, ``fp`` (of the first seed) and ``least`` of every row.

    ``least`` has the smallest ``id`` of the row's class, and its ``text_hash``.
    Rows are linked if the fingerprints of any seed differ in at most ``radius``
    bits, and a class is what links reach; null and empty texts have fingerprint
    zero, linked like any other.  Equal fingerprints are one node, whatever number
    of rows has them, so copies cost one row.  Null ids sort last; repeated rows
    get the same result each; an empty table gives no rows.
    """
    names = [f"fp{k}" for k in range(len(seeds))]
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    for name, seed in zip(names, seeds, strict=True):
        rows = with_fingerprint(rows, name=name, width=width, seed=seed, bits=bits)
    rows = written(rows.select("id", F.xxhash64("text").alias("text_hash"), *names), "fingerprints")
    total = rows.count()
    # Nodes: each distinct combination of fingerprints, named by a hash unless it is one.
    node = F.col("fp0") if len(seeds) == 1 else F.xxhash64(*names)
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    nodes = written(rows.groupBy(*names).agg(F.min(first).alias("least"), F.count(F.lit(1)).alias("n"))
                    .withColumn("node", node), "nodes")
    count = nodes.count()
    edges = []
    for name in names:
        found = links(nodes.select(F.col(name).alias("fp")).distinct(), count, radius, bits)
        edges.append(found if len(seeds) == 1 else _between_nodes(found, nodes, name))
    parts = components(reduce(DataFrame.unionByName, edges))
    member = nodes.join(parts, "node", "left").select(
        "node", "n", "least", F.coalesce("component", "node").alias("part"))
    member = written(member, "members")
    least = member.groupBy("part").agg(F.min("least").alias("class_least"), F.count(F.lit(1)).alias("members"))
    named = look_up(member, least, "part", ["class_least"], "members", count, F.col("node")).select(
        "node", "n", F.col("class_least").alias("least"))
    return look_up(rows.withColumn("node", node), named, "node", ["least"], "n", total, F.col("text_hash")).select(
        "id", "text_hash", F.col("fp0").alias("fp"), "least")


def _between_nodes(found: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """Links between fingerprints of one seed as links between nodes, those of equal fingerprints included."""
    first = nodes.groupBy(name).agg(F.min("node").alias("first"))
    equal = nodes.join(first, name).select(F.col("node").alias("u"), F.col("first").alias("v")).filter("u <> v")
    u = first.select(F.col(name).alias("u"), F.col("first").alias("nu"))
    v = first.select(F.col(name).alias("v"), F.col("first").alias("nv"))
    other = found.join(u, "u").join(v, "v").select(F.col("nu").alias("u"), F.col("nv").alias("v"))
    return equal.unionByName(other)


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One row of each class, the one with the smallest id, with the columns of ``docs``.

    A class without any id keeps the row whose text has the smallest hash; of
    rows that repeat id and text one stays.
    """
    found = classes(docs, id_column, text_column, **settings)
    return keep_rows(docs, found.select("least.*").distinct(), id_column, text_column)


def keep_rows(docs: DataFrame, least: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows of ``docs`` named in ``least`` by distinct ``id`` and ``text_hash``, one of each."""
    def key(of: DataFrame, id_: str, text_hash: Column) -> DataFrame:
        return of.withColumns({"k1": F.coalesce(F.col(id_).cast("string"), F.lit("")), "k2": text_hash})

    keep = key(least, "id", F.col("text_hash")).select("k1", "k2")
    rows = key(carried(docs, id_column, text_column), "id", F.xxhash64("text")).select("k1", "k2", "row")
    # The join has sorted its rows by the window's keys already.
    again = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k2"))
    return rows.join(keep, ["k1", "k2"], "left_semi").withColumn("again", again).filter("again = 1").select("row.*")
