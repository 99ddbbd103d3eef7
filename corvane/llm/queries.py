"""The queries opN_<name> over the given tables, and their SQL for DuckDB where SQL can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import bwt_dedup, centroids, chat, decontam, importance, langid, mixing, near_dedup, quality_rules, ranker, sentence_dedup, sql, token_scan, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(chat.as_messages(table(spark, sf_dir, "conversations")), chat.ASK)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentence_dedup.sentence_dedup(table(spark, sf_dir, "documents"))
    return out.select("*", F.sha2("kept", 256).alias("kept_sha256")).drop("kept")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranker.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(table(spark, sf_dir, "documents"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_near_duplicates, op3_sentence_spans, op4_decontaminate, op5_quality_rank, op6_warc, op7_substring_dedup, op8_token_counts, op9_mixture, op10_quality_rules, op11_importance_resample, op12_centroid_clusters, op13_language_id)}

#: op5, op8, op10 and op13 have none: SQL can't express a fitted model, a tokenizer's merges or the suffix arrays' verdict.
ORACLE_SQL = {
    "op1_chat_format": sql.OP1,
    "op2_near_duplicates": sql.OP2,
    "op3_sentence_spans": sql.OP3,
    "op4_decontaminate": sql.OP4,
    "op6_warc": sql.OP6,
    "op7_substring_dedup": sql.OP7,
    "op9_mixture": sql.OP9,
    "op11_importance_resample": sql.OP11,
    "op12_centroid_clusters": sql.OP12,
}
