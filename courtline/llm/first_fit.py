"""First-fit-decreasing packing with a tournament tree of bin capacities, in randomised groups of documents.

Pieces are dealt out at random into groups of bounded size.  Each group is packed by
itself: its pieces, longest first, go into the first bin that has room for them.
Bins are the leaves of a tournament tree whose inner nodes know the most room below
them, so the first such bin is found in as many steps as the tree is deep.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.llm import text_arrays as ta
from courtline.llm.common import text_or_empty, written
from courtline.llm.packing import END, encoder

CAPACITY = 1024
# Pieces that a group packs, on average at most.
GROUP_PIECES = 20_000
SEED = 42


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text",
           keep_ids: bool = False) -> DataFrame:
    """``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, if wanted, ``ids`` (32-bit little-endian) of every piece.

    Each document's ids are closed by ``END``; null and empty texts have it alone.
    Only documents longer than ``capacity`` are cut, into full pieces and a rest.
    Other columns of ``docs`` are left out.
    """
    schema = T.StructType([
        T.StructField("id", docs.schema[id_column].dataType), *(T.StructField(c, T.LongType()) for c in (
            "start", "length", "ids_crc32", "doc_tokens")), *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for part, _ in ta.slices(batch):
                rows, columns = [], {name: [] for name in schema.names[1:]}
                for row, text in enumerate(part.column("text").to_pylist()):
                    ids = np.array([*encode(text), END], "<u4")
                    for a in range(0, len(ids), capacity):
                        data = ids[a:a + capacity].tobytes()
                        rows.append(row)
                        for column, value in zip(columns.values(), (a, len(data) // 4, zlib.crc32(data), len(ids), data)):
                            column.append(value)
                kinds = (*[pa.int64()] * 4, pa.binary())
                yield pa.record_batch({"id": part.column("id").take(pa.array(rows, pa.int64()))} | {
                    name: pa.array(c, t) for (name, c), t in zip(columns.items(), kinds)})

    return docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")).mapInArrow(cut, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ties keep their order.

    ``room[1]`` is the tournament's winner, the children of node k are 2k and
    2k + 1, and bin i is leaf ``leaves + i``.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < n:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= n
        while node > 1:
            node //= 2
            winner = max(room[2 * node], room[2 * node + 1])
            if room[node] == winner:
                break
            room[node] = winner
    return bins, offsets


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``cut`` (see ``pieces``) with ``sequence_id`` and ``offset``; a sequence's pieces lie gapless from 0.

    A piece's group is drawn at random when the pieces are written, so no id, text
    or length can crowd a group: repeated rows are placed each, null ids like any
    other.  Only the number of pieces reaches the driver.  An empty table gives no
    rows.  A sequence ends with its last piece: the rest up to ``capacity`` is padding.
    """
    cut = written(cut.withColumn("__lot", F.rand(SEED)), "first-fit-pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("__group", F.floor(F.col("__lot") * groups)).drop("__lot")
    schema = T.StructType([*(f for f in cut.schema if f.name != "__lot"), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(key: tuple, table: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        return table.drop_columns(["__group"]).append_column(
            "sequence_id", pa.array((key[0].as_py() << 32) + bins)).append_column("offset", pa.array(offsets))

    # Dealt out by hand: adaptive execution would merge many groups into one task, as their rows are short.
    parts = min(groups, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(parts, "__group").groupBy("__group").applyInArrow(place, schema)
