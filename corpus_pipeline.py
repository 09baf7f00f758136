"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsrisk.llm import decontaminate, language_id, line_dedup, sentencepiece_codec, simhash_dedup
from newsrisk.llm.common import write_table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter (or text), and those between two languages, go, row by row."""
    return language_id.identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that an earlier line resembles go; every document keeps its row."""
    return line_dedup.dedup_lines(docs).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the smallest doc_id stays."""
    return simhash_dedup.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window like an item go."""
    return decontaminate.clean_of(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: adds ids, n_tokens, score and exact (decoding gives the text back)."""
    return sentencepiece_codec.encode_text(docs, check=True)


STAGES = [
    ("language_id", identify),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", near_dedup),
    ("decontaminate", remove_benchmark),
    ("sentencepiece", encode),
]

#: Fitted n-gram models and best paths have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
