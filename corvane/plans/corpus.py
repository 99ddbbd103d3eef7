"""Whole runs: building Gold, the duration report, packing and resuming; each a few operators in a row."""

from __future__ import annotations

import logging
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.config import DATASET, SCHEMA_VERSION, CorpusConfig, ReaderSettings
from corvane.functions.text import round4
from corvane.operators import duration, gold, integrity, quality, samples, state
from corvane.operators import manifest as M
from corvane.sinks import files, shards
from corvane.sources import archive, manifest, members, metadata


log = logging.getLogger("corvane.corpus")


def now() -> str:
    return datetime.now(UTC).isoformat()


def build_gold(spark: SparkSession, c: CorpusConfig, allow_partial: bool = False, label: str = "partial", clock=now) -> bool:
    """Write the manifests of all splits and their description; False, and nothing written, if speakers are incomplete and allow_partial
    isn't set."""
    dimension = gold.split_dimension(spark, c)
    for name in metadata.unreadable(spark, c.metadata):
        log.warning("%s can't be read and is left out", name)
    meta = metadata.speakers(spark, c.metadata)
    missing = [r["speaker_id"] for r in gold.incomplete(dimension, meta).orderBy("ordinal").collect()]
    if missing and not allow_partial:
        return False
    rows = gold.gold_rows(meta, dimension, c).cache()
    partial = bool(missing) and allow_partial
    files.manifests(rows, c.gold, label if partial else None)
    splits = gold.split_speakers(c.usable(), c.split_seed, c.train, c.val, c.test)
    files.write_json(
        f"{c.gold}/split_metadata.json",
        {
            "schema_version": SCHEMA_VERSION, "strategy": "speaker_disjoint", "seed": c.split_seed, "train_count": c.train, "val_count": c.val, "test_count": c.test,
            **{f"{k}_speakers": v for k, v in splits.items()}, "excluded_speakers": list(c.excluded), "partial": partial, "missing_speakers": missing, "generated_at": clock(), "utterance_counts": gold.split_counts(rows),
        },
    )
    rows.unpersist()
    return True


def gold_when_done(spark: SparkSession, c: CorpusConfig, states: DataFrame) -> bool:
    """Build Gold once every usable speaker is done."""
    return state.all_done(states) and build_gold(spark, c)


def document_parts(records: DataFrame, shard_info: DataFrame, sources: DataFrame, c: CorpusConfig, clock=now) -> tuple[DataFrame, DataFrame]:
    """Speakers' metadata from quality records, shards(speaker_id, path, size, sha256) and sources(speaker_id, video_source_used, audio_source_used), as
    sinks.files.long_documents takes them: ends(speaker_id, head, tail) and items(speaker_id, place, text), a sample each."""
    names = ("utterance_id", "valid", "invalid_reason", "source_fps", "source_frame_count", "cropped_frame_count", "face_detection_ratio", "max_consecutive_face_frames", "detected_frame_indices", "audio_duration_sec", "audio_sample_rate", "audio_channels", "shard_member_prefix")
    whole = {"ignoreNullFields": "false"}
    df = quality.summarise(records).join(shard_info, "speaker_id").join(sources, "speaker_id")
    head = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(DATASET).alias("dataset"), "speaker_id", F.lit("DONE").alias("status"), F.struct("video_source_used", "audio_source_used").alias("source"),
        F.struct(F.lit(c.fps).alias("expected_fps"), F.lit(c.audio_rate).alias("target_audio_sample_rate"), F.lit(c.min_face_ratio).alias("min_face_detection_ratio"), F.lit(c.min_consecutive).alias("min_consecutive_face_frames")).alias("processing"),
        F.struct("total_candidates", "valid_samples", "invalid_samples").alias("summary"), "invalid_reason_counts",
    )
    tail = F.struct(F.struct("path", F.col("size").alias("size_bytes"), "sha256").alias("shard"), F.lit(clock()).alias("generated_at"))
    ends = df.select("speaker_id", opening(F.to_json(head, whole)).alias("head"), closing(F.to_json(tail, whole)).alias("tail"))
    items = records.withColumn("face_detection_ratio", round4("face_detection_ratio")).select("speaker_id", F.struct(*names).alias("place"))
    return ends, items.select("speaker_id", "place", F.to_json("place", whole).alias("text"))


def opening(head: Column) -> Column:
    """Of a document's fields before its samples, the text up to the first sample."""
    return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"samples":['))


def closing(tail: Column) -> Column:
    """Of the fields after them, the text from there."""
    return F.concat(F.lit("],"), F.substring(tail, F.lit(2), F.length(tail) - 1))


def speaker_documents(records: DataFrame, shard_info: DataFrame, sources: DataFrame, c: CorpusConfig, clock=now) -> DataFrame:
    """speaker_id, json: document_parts() put together, for speakers whose documents fit in a row."""
    ends, items = document_parts(records, shard_info, sources, c, clock)
    listed = items.groupBy("speaker_id").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("listed"))
    return ends.join(listed, "speaker_id").select("speaker_id", F.concat("head", F.array_join("listed.text", ","), "tail").alias("json"))


def pack(spark: SparkSession, contents: DataFrame, valid: DataFrame, folder: str) -> DataFrame:
    """Pack the members of valid(speaker_id, utterance_id) and check that none is missing."""
    info = shards.package(contents.join(valid, ["speaker_id", "utterance_id"], "left_semi"), folder)
    lost = integrity.missing_from_shards(valid, archive.members(spark, folder)).take(1)
    if lost:
        raise integrity_error(lost[0])
    return info


def integrity_error(row):
    from corvane.errors import ShardError

    return ShardError(f"{row['speaker_id']}/{row['utterance_id']} is not in its shard")


def report(spark: SparkSession, settings: ReaderSettings, folder: str, root: str | None = None) -> dict[str, str]:
    """The three files of the duration report, from the manifests below the data root. Raises if there are no utterances."""
    rows = duration.checked(manifest.load_all(spark, root or settings.data_root))
    rows = M.eligible(rows, settings.min_frame_count)
    g = duration.gaps(rows.select("*"), settings.fps, settings.gap_threshold_ms).cache()
    summary = duration.summarise(g)
    if not g.take(1):
        raise ValueError("there are no utterances to report on")
    out = files.report(g, duration.report_order(summary, rows), folder)
    g.unpersist()
    return out


def read_samples(spark: SparkSession, settings: ReaderSettings, split: str, speakers: list[str] | None = None, decoder=None) -> DataFrame:
    """Samples of a split: eligible manifest rows, their frames' bytes, decoded audio and durations. speakers prune the archives read; of these
    headers are indexed, and the bytes of the rows' own members are read. With a decoder frames come as pixels of the settings' size."""
    rows = M.eligible(manifest.load(spark, settings.data_root, split), settings.min_frame_count)
    rows = rows if speakers is None else rows.where(F.col("speaker_id").isin(speakers))
    index = members.sound(members.of_folder(spark, f"{settings.data_root}/silver/shards", speakers=speakers))
    out = samples.samples(rows, index, settings.fps)
    return out if decoder is None else samples.with_pixels(out, decoder, settings.frame_width, settings.frame_height)


def at(spark: SparkSession, settings: ReaderSettings, split: str, index: int) -> DataFrame:
    """The manifest's row at a place of a split."""
    return M.at(manifest.load(spark, settings.data_root, split), split, index)


def resume(spark: SparkSession, c: CorpusConfig, events: DataFrame, force: bool = False, clock=now) -> tuple[DataFrame, DataFrame]:
    """Speakers still to process, and events that reconcile the state of those whose artefacts verify."""
    catalogue = spark.createDataFrame([(s,) for s in c.usable()], "speaker_id string")
    checked = state.verified(state.state(catalogue, events), metadata.inventory(spark, c.shards, c.metadata)).cache()
    return state.to_process(checked, force), state.reconciled(checked, c.shards, c.metadata, clock())
