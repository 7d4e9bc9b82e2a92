"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (bpe, decontam, divergence, line_dedup, merkle, pieces, ppm, quality, secret_scan, shards,
                         simhash, suffix_dedup, url_filter)
from barloom.llm.text import table


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.assign_documents(table(spark, folder, "documents"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    decoded = pieces.decode(pieces.encode(table(spark, folder, "documents")))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", "n_ids", "ids", same.alias("round_trip"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("char_distance", "word_distance")


def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.compare(table(spark, folder, "documents"))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audit(table(spark, folder, "documents"))


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(table(spark, folder, "documents"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_secrets": op2_secrets,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_decontamination": op5_decontamination,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_quality": op8_quality,
    "op9_lm_score": op9_lm_score,
    "op10_simhash": op10_simhash,
    "op11_source_divergence": op11_source_divergence,
    "op12_merkle": op12_merkle,
    "op13_bpe": op13_bpe,
}
