"""Exact deduplication in two passes over a Bloom filter of repeated hashes.

The first pass hashes every text and marks, in a blocked Bloom filter, the bits
that at least two rows set.  The second pass lets every row whose bits are not
all marked pass straight through; only the others, the possible repeats, are
shuffled by their full hash.  Everything is column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import BROADCAST_BYTES, carried, look_up, text_or_empty, written

# Bits of the filter per row.  A row sets two of them, within one 64-bit word.
BITS_PER_ROW = 16
# Bytes that a word takes as a row of a broadcast hash table.
WORD_BYTES = 40


def with_digest(docs: DataFrame, text_column: str = "text", name: str = "digest") -> DataFrame:
    """Adds the SHA-256 of the text as binary; a null text counts as empty."""
    return docs.withColumn(name, F.unhex(F.sha2(text_or_empty(text_column).cast("binary"), 256)))


def _probe(digest: Column, words: int) -> tuple[Column, Column, Column]:
    """A digest's word in the filter and its two different bits there."""
    h = F.xxhash64(digest, F.lit(1))
    first = F.pmod(h, F.lit(64)).cast("int")
    step = 1 + F.pmod(F.shiftrightunsigned(h, 32), F.lit(63)).cast("int")
    return F.pmod(F.xxhash64(digest), F.lit(words)), first, F.pmod(first + step, F.lit(64))


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position)


def repeated_bits(hashed: DataFrame, words: int, digest: str = "digest") -> DataFrame:
    """First pass: ``word`` and ``mask`` of the filter's bits that two or more rows set."""
    word, first, second = _probe(F.col(digest), words)
    set_bits = hashed.select(word.alias("word"), F.explode(F.array(first, second)).alias("bit"))
    twice = set_bits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("word").agg(F.bit_or(_bit(F.col("bit"))).alias("mask"))


def copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with its ``digest``, ``keep_id``, ``group_size`` and ``kept``.

    Of the rows with one text, the one with the largest id is kept (``keep_id``);
    null ids count as smaller than any other, and ``keep_id`` is null if no row of
    the group has an id.  A null text equals the empty one.  Rows that repeat
    both id and text are all marked as kept: ``drop_copies`` leaves one of them.
    An empty table gives an empty result.  Columns of ``docs`` stay; if one has
    the name of a result column, the result replaces it.

    Runs one pass that writes 40 bytes a row to the shared folder.  The filter has
    ``BITS_PER_ROW`` bits a row, but never takes more than ``BROADCAST_BYTES`` as a
    broadcast table: with more rows than that it lets more of them through to the
    shuffle by chance, and the result is the same.
    """
    results = ["digest", "keep_id", "group_size", "kept"]
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in results or c in (id_column, text_column)))
    narrow = written(with_digest(docs.select(id_column, text_column), text_column).select(
        F.col(id_column).alias("id"), "digest"), "digests")
    total = narrow.count()
    words = max(1, min(total * BITS_PER_ROW, BROADCAST_BYTES // WORD_BYTES * 64) // 64)
    marks = F.broadcast(repeated_bits(narrow, words))

    def possible(rows: DataFrame) -> tuple[DataFrame, Column]:
        word, first, second = _probe(F.col("digest"), words)
        need = _bit(first).bitwiseOR(_bit(second))
        joined = rows.withColumn("__word", word).join(
            marks.withColumnsRenamed({"word": "__word", "mask": "__mask"}), "__word", "left")
        return joined, F.coalesce(F.col("__mask").bitwiseAND(need) == need, F.lit(False))

    seen, again = possible(narrow)
    groups = seen.filter(again).groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))

    if set(docs.columns) == {id_column, text_column}:
        rows = narrow.withColumnRenamed("id", id_column)
    else:
        rows = with_digest(docs, text_column)
    marked, again = possible(rows)
    every = [F.col(f"`{c}`") for c in rows.columns]
    through = marked.filter(~again).select(
        *every, F.col(id_column).alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    shuffled = look_up(marked.filter(again).select(*every), groups, "digest",
                       ["keep_id", "group_size"], "group_size", total, F.col(id_column))
    return through.unionByName(shuffled).withColumn("kept", F.col(id_column).eqNullSafe(F.col("keep_id")))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each text, with the columns of ``docs``, whatever their names."""
    kept = copies(carried(docs, id_column, text_column), "id", "text").filter("kept")
    single = kept.filter("group_size = 1")
    several = kept.filter("group_size > 1").dropDuplicates(["id", "digest"])
    return single.unionByName(several).select("row.*")
