"""A cleaning pipeline over `documents`: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import decontam, line_dedup, pieces, quality, simhash
from barloom.llm.text import table
from barloom.session import cut


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines that nearly equal an earlier line go; every document stays, with what is left."""
    return line_dedup.trim(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, folder, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids of what is left, with its text."""
    return pieces.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece_encoding", encoding),
]

# The stages are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The last stage's rows; what every stage returns is written and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, folder), name)
    return docs
