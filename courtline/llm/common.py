"""What the operators of this package share: written tables, folds, skew-safe look-ups."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A key with more than this share of the rows is looked up by broadcast, so at
# most 1 / HOT_SHARE keys are, whatever the size of the input.
HOT_SHARE = 1e-3
SALTS = 1024
# Largest lookup table that may be broadcast or put into a task's closure.
BROADCAST_BYTES = 64 * 2**20


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only where one machine does all the work, as in tests, a folder beside the
    warehouse does instead; a cluster without a shared folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % modulus


def carried(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``text`` and the whole row as the struct ``row``, so that no column of ``docs`` can clash."""
    return docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def look_up(rows: DataFrame, table: DataFrame, key: str, values: Sequence[str], weight: str | None,
            total: int, spread: Column) -> DataFrame:
    """Left join of ``rows`` with ``table`` (one row per key) that no hot key can stall.

    ``table[weight]`` says how many of the ``total`` rows carry the key, of which
    there is none that the table lacks; without ``weight`` the rows of every key
    are counted first, and keys that the table lacks may be hot like any other.
    Keys with over ``HOT_SHARE`` of the rows, of which there are at most 1000, come
    by broadcast; their rows are dealt out by ``spread`` in the shuffled join with
    the other keys.
    """
    limit = max(1, int(total * HOT_SHARE))
    renamed = {v: f"__hot_{v}" for v in values}
    if weight is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).select(key)
        known, cold_table = counts.join(table, key, "left"), table.join(F.broadcast(counts), key, "left_anti")
    else:
        known, cold_table = table.filter(F.col(weight) > limit), table.filter(F.col(weight) <= limit)
    hot = known.select(F.col(key), *(F.col(v).alias(n) for v, n in renamed.items()), F.lit(True).alias("__hot"))
    # One struct as the key: with two columns Spark would deal the rows out by ``key`` alone.
    cold = cold_table.select(F.struct(F.col(key).alias("key"), F.lit(0).alias("salt")).alias("__dealt"), *values)
    marked = rows.join(F.broadcast(hot), key, "left").withColumn(
        "__dealt", F.struct(F.col(key).alias("key"), F.when(
            F.col("__hot"), 1 + F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")))
    joined = marked.join(cold, "__dealt", "left")
    return joined.select(
        *(F.col(f"`{c}`") for c in rows.columns), *(F.coalesce(F.col(n), F.col(v)).alias(v) for v, n in renamed.items()))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, most: int,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``order``, ``label`` and ``text`` of at most ``most`` training rows, those with the smallest hashes.

    Rows whose remainder is 0 are held out, null labels ignored; of several labels
    of one id the largest counts, of several texts the one with the smallest hash.
    Only the sample's ids, bounded by ``most``, are broadcast; no other text is
    shuffled.
    """
    usable = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & (remainder("id", modulus) != 0))
    chosen = usable.groupBy("id").agg(F.max("label").alias("label")).withColumn(
        "order", F.xxhash64("id")).orderBy("order", "id").limit(most)
    texts = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    # Each task leaves one row of an id before the shuffle, however many it has.
    first = F.row_number().over(Window.partitionBy("id").orderBy("hash", "text"))
    found = texts.join(F.broadcast(chosen), "id").withColumn("hash", F.xxhash64("text")).withColumn("nth", first)
    return found.filter("nth = 1").select("order", "label", "text")
