"""The registered queries of the operators, each over the whole of its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsrisk.llm import decontaminate, fair_mixing, hard_negatives, language_id, line_dedup, multi_index, secret_scan, sentencepiece_codec, simhash_dedup, sqltext, substring_dedup, token_counts, vector_codes, warc_archive


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 10))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_components(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan_secrets(docs, secret_scan.fit(docs))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode_text(docs, check=True).select("doc_id", "ids", "n_tokens", "score", "exact")


def op11_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mixing.mix(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc_archive": op2_warc_archive,
    "op3_multi_index": op3_multi_index,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_fair_mixing": op11_fair_mixing,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The others have no SQL form (fitted models, approximate search, hashes that SQL lacks): tests/llm has a plain version of each.
ORACLE: dict[str, str] = {
    "op2_warc_archive": sqltext.WARC,
    "op4_decontaminate": sqltext.DECONTAMINATE,
    "op6_line_dedup": sqltext.LINE_DEDUP,
    "op11_fair_mixing": sqltext.FAIR_MIXING,
    "op12_vector_codes": sqltext.VECTOR_CODES,
    "op13_hard_negatives": sqltext.HARD_NEGATIVES,
}
