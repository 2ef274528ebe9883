"""The registered queries of this package: thin digests of its operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import (
    context_tree,
    decontamination,
    exact_dedup,
    first_fit,
    hard_negatives,
    language_id,
    packing,
    periodic_runs,
    pii,
    quality,
    simhash,
    toxicity,
    url_reputation,
)
from courtline.llm.common import remainder, text_or_empty
from courtline.llm.url_reputation import Rule

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = context_tree.score(docs.withColumn("train", context_tree.training_rows("doc_id")))
    return scored.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score", "bits_per_byte")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.classes(docs).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least.id").alias("component_id"))


def tokenizer_path() -> str:
    """The byte-level BPE file, wherever the installed package of public tokenizers keeps it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_reputation.judge(pages, table(spark, sf_dir, "labels"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.profiles(docs)
    return language_id.with_language(docs, found).select(
        "doc_id", (remainder("doc_id", language_id.HELD_OUT) == 0).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model).select(
        "doc_id", (remainder("doc_id", toxicity.HELD_OUT) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.copies(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, tokenizer_path())).withColumnRenamed("id", "doc_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array(*map(F.lit, pii.KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def place(s: Column) -> Column:
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    every = F.sort_array(F.concat(F.transform("base", place), F.transform("found", place)))
    def number(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(every).alias("spans"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, network).select(
        "doc_id", (remainder("doc_id", quality.HELD_OUT) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return first_fit.pack(first_fit.pieces(docs, tokenizer_path())).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(moved, F.col("vec_id") % 50 == 0, id_column="vec_id", vector_column="embedding").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The texts of a tenth of the ids, chosen by hash, with all words from a place on replaced by a repeated stretch."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.regexp_extract_all(text_or_empty(), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    w = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumn("g", F.floor(h / 10)).withColumn(
        "n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))

    def word(i: Column) -> Column:
        return F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), word), " ")
    return w.withColumn("p", p).select("doc_id", F.when(F.col("n") > 0, planted).otherwise(text_or_empty()).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_period(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.with_runs(docs).select(
        "doc_id", "repeated.runs", "repeated.collapsed", periodic_runs.longest(F.col("repeated.runs")).alias("best"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    "op1_context_tree": op1_context_tree,
    "op2_simhash": op2_simhash,
    "op3_host_reputation": op3_host_reputation,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}
