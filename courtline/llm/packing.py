"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only lengths matter to a packing, so it is planned on the histogram of lengths, of
which there are at most as many as a sequence has tokens, whatever the number of
documents.  The plan's places are then dealt out by rank among pieces of a length.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import ArrowUDFType

from courtline.llm import text_arrays as ta
from courtline.llm.common import text_or_empty, written

CAPACITY = 2048
END = 0
# Pieces of one length that one task ranks, on average at most.
RANKED_TOGETHER = 50_000

# The word pattern of the byte-level tokenizer: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# Runs of white space from which on a text is left to the tokenizers library: tiktoken's pattern goes back
# over them and overflows its stack at somewhere near a million.
LONG_RUN = re.compile(r"\s{10000}")


@cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """What gives the ids of the tokenizers library (``add_special_tokens=False``) for the byte-level BPE file.

    Texts with an added token's string or very long white space go to that
    library itself, all others to tiktoken, which is faster and equal on them.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    fast = encoding(path).encode_ordinary

    def encode(text: str) -> list[int]:
        if any(token in text for token in added) or LONG_RUN.search(text):
            return tokenizer.encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


@cache
def encoding(path: str):
    """tiktoken's encoder for the byte-level BPE file (vocabulary in tokenizers' JSON format).

    The file spells bytes as printable characters; the ids are the merge ranks.
    Special tokens' strings in a text are ordinary text here, see ``encoder``.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["content"] for t in model.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole if it fits, else full ones after a shorter first."""
    first = n % capacity or capacity
    if n <= capacity:
        return [(0, n)]
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text",
           keep_ids: bool = False) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, ``ids`` (32-bit little-endian) of every piece.

    Each document's ids are closed by ``END``; null and empty texts have it alone.
    """
    kind = docs.schema[id_column].dataType
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for part, _ in ta.slices(batch):
                rows, columns = [], [[], [], [], [], []]
                for row, text in enumerate(part.column("text").to_pylist()):
                    ids = np.array([*encode(text or ""), END], "<u4")
                    for k, (a, n) in enumerate(cuts(len(ids), capacity)):
                        rows.append(row)
                        data = ids[a:a + n].tobytes()
                        for column, value in zip(columns, (k, a, n, zlib.crc32(data), data), strict=True):
                            column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("piece", "start", "length", "ids_crc32", "ids")[:5 if keep_ids else 4]
                yield pa.record_batch({"id": part.column("id").take(pa.array(rows, pa.int64()))} | {
                    name: pa.array(c, t) for name, c, t in zip(names, columns, kinds)})

    return docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")).mapInArrow(cut, schema)


class Pattern(NamedTuple):
    """Equal sequences: (length, copies) of what each holds, and how many of them there are."""

    content: tuple[tuple[int, int], ...]
    times: int


def dominating(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Martello-Toth reduction: takes sets that dominate all others with their largest item out of ``counts``.

    Such a set can be fixed for good, as some best packing holds it: an item that
    nothing fits beside; a pair that fills a sequence; and the largest item that
    fits beside another where no two items do.
    """
    fixed = []
    changed = True
    while changed:
        changed = False
        for large in np.flatnonzero(counts)[::-1]:
            large = int(large)
            while counts[large]:
                room = capacity - large
                counts[large] -= 1
                beside = np.flatnonzero(counts[:room + 1])
                smallest = int(beside[0]) if len(beside) else None
                counts[large] += 1
                if smallest is None:
                    fixed.append(Pattern(((large, 1),), int(counts[large])))
                    counts[large] = 0
                    changed = True
                    break
                partner = int(beside[-1])
                second = smallest if counts[smallest] - (smallest == large) >= 2 else next(
                    (int(x) for x in np.flatnonzero(counts) if x > smallest and counts[x] - (x == large) > 0), capacity + 1)
                if partner != room and smallest + second <= room:
                    break
                if partner == large:
                    times = int(counts[large]) // 2
                    content = ((large, 2),)
                else:
                    # All at once: with fewer items left, still no two fit beside the large one.
                    times = int(min(counts[large], counts[partner]))
                    content = ((large, 1), (partner, 1))
                fixed.append(Pattern(content, times))
                for length, copies in content:
                    counts[length] -= copies * times
                changed = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, lengths in decreasing order: each item goes where it leaves least room."""
    open_: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if pattern.times:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append(pattern)

    def filled(room: int, pattern: Pattern, length: int, n: int) -> int:
        """Fill ``n`` items of a length into equal sequences; how many were placed."""
        copies = room // length
        whole = min(pattern.times, n // copies)
        put(room - copies * length, Pattern((*pattern.content, (length, copies)), whole))
        placed, rest = whole * copies, pattern.times - whole
        if rest and placed < n and n - placed < copies:
            put(room - (n - placed) * length, Pattern((*pattern.content, (length, n - placed)), 1))
            rest, placed = rest - 1, n
        put(room, Pattern(pattern.content, rest))
        return placed

    for length in np.flatnonzero(counts)[::-1]:
        length, n = int(length), int(counts[length])
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                n -= filled(capacity, Pattern((), -(-n // (capacity // length))), length, n)
                continue
            room = rooms[at]
            pattern = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            n -= filled(room, pattern, length, n)
    return [p for some in open_.values() for p in some]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Places by length and rank: from ``rank`` on, ``copies`` in each sequence from ``sequence`` on, at ``offset``."""
    counts = counts.copy()
    rows = {name: [] for name in ("length", "rank", "copies", "sequence", "offset")}
    next_rank = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for pattern in [*dominating(counts, capacity), *best_fit(counts, capacity)]:
        offset = 0
        for length, copies in pattern.content:
            for name, value in zip(rows, (length, next_rank[length], copies, sequence, offset), strict=True):
                rows[name].append(value)
            next_rank[length] += copies * pattern.times
            offset += copies * length
        sequence += pattern.times
    table = {name: np.array(values, np.int64) for name, values in rows.items()}
    order = np.lexsort((table["rank"], table["length"]))
    return {name: values[order] for name, values in table.items()}


PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (see ``pieces``) with ``sequence_id`` and ``offset``.

    Pieces of one length are interchangeable; which of them gets which place
    follows from a hash of their columns.  They are ranked in buckets whose number
    grows with the input, so a very common length is no one task's burden.  Only
    the histogram of lengths, at most ``capacity`` numbers, reaches the driver.
    An empty table gives no rows; repeated pieces are placed each.
    """
    spark = cut.sparkSession
    cut = written(cut, "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.length] = r.n
    buckets = max(1, int(counts.sum()) // RANKED_TOGETHER)
    key = F.xxhash64("id", "piece", "start", "ids_crc32")
    bucketed = cut.withColumns({"key": key, "bucket": F.pmod(key, F.lit(buckets))})
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("key", "id", "piece")) - 1
    ranked = bucketed.withColumn("rank", rank).join(offsets, ["length", "bucket"]).withColumn(
        "rank", F.col("rank") + F.col("before"))
    sent = spark.sparkContext.broadcast(plan(counts, capacity))

    def place(lengths: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        p = sent.value
        first = np.searchsorted(p["length"], np.arange(capacity + 2))
        top = int(p["rank"].max(initial=0)) + 1
        keys = p["length"] * top + p["rank"]
        for length, rank in lengths:
            length, rank = length.to_numpy(), rank.to_numpy()
            at = np.searchsorted(keys, length * top + np.minimum(rank, top - 1), side="right") - 1
            at = np.maximum(at, first[length])
            copies = p["copies"][at]
            nth = rank - p["rank"][at]
            yield pa.StructArray.from_arrays(
                [pa.array(p["sequence"][at] + nth // copies), pa.array(p["offset"][at] + nth % copies * length)],
                ["sequence_id", "offset"])

    udf = F.arrow_udf(place, PLACE, ArrowUDFType.SCALAR_ITER)
    return ranked.withColumn("place", udf("length", "rank")).select(*cut.columns, "place.*")
