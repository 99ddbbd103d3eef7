"""A training-data pipeline over `documents`: what each stage keeps is written as Parquet and is the next stage's input.

All stages but the last return the columns of documents. Stages handle nulls, ties and empty tables as their operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import bwt_dedup, decontam, mixing, near_dedup, quality_rules
from corvane.llm.common import delete, new_folder, passing


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the least id."""
    return near_dedup.representatives(docs, near_dedup.Params(shingle=5, pct=80))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that documents of smaller id have; documents of which nothing is left go."""
    return bwt_dedup.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by target weights of sources, languages and topics; 80 % of the tokens, in expectation. No target exceeds what there
    is; where targets contradict each other, mixing.margins gives them beside what is drawn."""
    return mixing.mixed(docs, mixing.Params(share=0.8))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated substrings", substrings),
    ("decontamination", decontaminated),
    ("mixture", mixture),
]

#: SQL can't express the verdict of the suffix arrays; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows. What a stage has made besides its output goes when that is written, the output when
    the next stage's is; nothing of other runs is deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with passing() as folders:
            out = new_folder(spark, name.replace(" ", "-"))
            stage(spark, docs, sf_dir).write.parquet(out)
            folders.remove(out)
        if before:
            delete(before)
        docs, before = spark.read.parquet(out), out
    return docs
