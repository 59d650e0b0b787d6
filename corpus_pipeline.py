"""From raw documents to packed training sequences: toxicity, language, repeated lines, near copies, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import lines, minhash, packing, queries
from shelfcast.llm.shared import materialise

#: Documents with a score from here on go, and documents whose best language has a smaller share than this.
TOXIC, UNSURE = 0.3, 0.4


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not reject."""
    return queries.toxic_scores(docs, spark, sf_dir).where(F.col("score") < TOXIC).select(docs.columns)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is told with some certainty."""
    return queries.language_rated(docs).where((F.col("lang_pred") != "und") & (F.col("score") >= UNSURE)).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without lines that nearly repeat an earlier one; n_chars follows the text, emptied documents stay."""
    cut = lines.drop_repeated_lines(docs, least=1)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies."""
    kept = materialise(minhash.near_duplicates(docs).where("kept").select("doc_id"))
    return docs.join(kept.where("doc_id is not null").distinct(), "doc_id", "left_semi").unionByName(docs.where("doc_id is null")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("language", in_a_language),
    ("line_dedup", without_repeated_lines),
    ("minhash", one_of_each),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
