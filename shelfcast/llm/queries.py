"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import conversations, html, language, lines, minhash, negatives, neighbours, packing, quality, shards, tokens, toxicity, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 0.8)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.main_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.risk_controlled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def toxic_scores(documents: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with held_out and score; the lexicon is learned from the labelled ones that are not held out."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    labels = table(spark, sf_dir, "labels").where(~held_out)
    lexicon = toxicity.learn(documents, labels)
    return toxicity.score(documents, lexicon).withColumn("held_out", held_out)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = toxic_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), spark, sf_dir)
    return rated.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shard_by_bytes(table(spark, sf_dir, "documents"), 8)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return dealt.select(
        "doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def language_rated(documents: DataFrame) -> DataFrame:
    """Documents with held_out, lang_pred and score; learned from those with a language that are not held out."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
    model = language.learn(documents.where(~held_out))
    return language.identify(documents, model).withColumn("held_out", held_out)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = language_rated(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", "held_out", "lang_pred", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tokens.round_trip(table(spark, sf_dir, "documents"), ranks, stable=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), least=1).select("doc_id", "n_lines", "n_removed", "text")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repaired = conversations.summarise(conversations.repair(conversations.damage(turns))).withColumnRenamed("conv_id", "key")
    whole = turns.select("conv_id").distinct().join(repaired, F.col("conv_id").eqNullSafe(F.col("key")), "left")
    numbers = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return whole.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_minhash, op2_main_text, op3_quality_rules, op4_toxicity, op5_histogram_sort, op6_language, op7_byte_bpe, op8_packing, op9_line_dedup,
        op10_near_vectors, op11_conversations, op12_neighbours, op13_hard_negatives,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": quality.oracle_sql(),
        "op9_line_dedup": lines.oracle_sql(least=1),
        "op10_near_vectors": vectors.oracle_sql(),
        "op11_conversations": conversations.oracle_sql(),
        "op13_hard_negatives": negatives.oracle_sql(),
    }
