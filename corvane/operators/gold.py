"""Gold: speaker-disjoint splits, completeness, and the manifest's rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.config import CorpusConfig
from corvane.schemas import MANIFEST_COLUMNS


def split_speakers(usable: list[str], seed: int, train: int, val: int, test: int) -> dict[str, list[str]]:
    """The speakers of each split: a shuffle by Python's generator, seeded, then slices. Spark's random numbers would give other splits."""
    order = list(usable)
    random.Random(seed).shuffle(order)
    return {"train": order[:train], "val": order[train : train + val], "test": order[train + val : train + val + test]}


def split_dimension(spark: SparkSession, c: CorpusConfig) -> DataFrame:
    """speaker_id, ordinal (numeric order), split (null beyond the three sizes). A few dozen rows at most."""
    of = {s: k for k, v in split_speakers(c.usable(), c.split_seed, c.train, c.val, c.test).items() for s in v}
    return spark.createDataFrame([(s, i, of.get(s)) for i, s in enumerate(c.usable())], "speaker_id string, ordinal int, split string")


def incomplete(dimension: DataFrame, metadata: DataFrame) -> DataFrame:
    """Speakers without readable metadata of status DONE."""
    return dimension.select("speaker_id", "ordinal").join(metadata.where("status = 'DONE'").select("speaker_id").distinct(), "speaker_id", "left_anti")


def gold_rows(metadata: DataFrame, dimension: DataFrame, c: CorpusConfig) -> DataFrame:
    """The manifest's columns, with ordinal and pos (the order of rows). Speakers whose status isn't DONE contribute too, if their
    metadata can be read: a partial build marks them as missing and still has their rows."""
    shard = F.coalesce(F.nullif(F.col("shard.path"), F.lit("")), F.concat(F.lit(f"{c.shards}/"), "speaker_id", F.lit(".tar")))
    known = dimension.where("split is not null")  # its size is fixed by the format: 33 rows
    m = metadata.where("speaker_id is not null").join(F.broadcast(known), "speaker_id")
    s = m.select("split", "speaker_id", "ordinal", shard.alias("shard_path"), F.posexplode("samples").alias("pos", "s")).where("s.valid")
    indices = F.col("s.detected_frame_indices")
    out = s.select(
        "split", "speaker_id", F.coalesce("s.utterance_id", F.lit("")).alias("utterance_id"), "shard_path", F.coalesce("s.shard_member_prefix", F.lit("")).alias("shard_member_prefix"),
        F.coalesce("s.cropped_frame_count", F.lit(0)).alias("frame_count"), F.array_min(indices).alias("first_frame_index"), F.array_max(indices).alias("last_frame_index"),
        F.col("s.face_detection_ratio").alias("face_detection_ratio"), F.col("s.audio_duration_sec").alias("audio_duration_sec"), F.col("s.audio_sample_rate").alias("audio_sample_rate"),
        F.lit(True).alias("valid"), "ordinal", "pos",
    )
    return out.select(*MANIFEST_COLUMNS, "ordinal", "pos")


def split_counts(rows: DataFrame) -> dict[str, int]:
    found = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    return {s: found.get(s, 0) for s in ("train", "val", "test")}
