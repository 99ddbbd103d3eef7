"""Quality of utterances: an ordered classification, and summaries by speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.config import CorpusConfig
from corvane.functions.runs import longest_run


def ratio(detected: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(detected.cast("double"), total.cast("double")), F.lit(0.0))


def reason(source: Column, cropped: Column, share: Column, run: Column, readable: Column, has_audio: Column, rate: Column, duration: Column, c: CorpusConfig) -> Column:
    """The first fault, null if there is none."""
    return (
        F.when(source == 0, "NO_FRAMES")
        .when((cropped == 0) | (share < c.min_face_ratio), "FACE_NOT_DETECTED")
        .when(run < c.min_consecutive, "INSUFFICIENT_CONSECUTIVE_FACE_FRAMES")
        .when(~readable, "CORRUPT_OUTPUT")
        .when(~has_audio, "AUDIO_DECODE_FAILED")
        .when(rate.isNull() | (rate != c.audio_rate), "INVALID_OUTPUT_AUDIO_RATE")
        .when(duration.isNull() | (duration < c.min_audio_sec), "EMPTY_AUDIO")
    )


def classify(utterances: DataFrame, c: CorpusConfig = CorpusConfig()) -> DataFrame:
    """From utterances(speaker_id, utterance_id, pairing_status, video_failed, video_reason, source_fps, total_frames, detected, audio_failed,
    audio_success, audio_reason, audio_duration_sec, audio_sample_rate, audio_channels, readable, has_audio) the quality record of each.
    A fault that comes earlier hides later ones, and how many fields are filled depends on where the checks ended: none for an unpaired
    utterance or one whose video raised; rate and count of frames if video has a fault or audio raised; detections as well if audio has
    one; all after the checks of the output."""
    u = utterances
    unpaired = F.col("pairing_status") != "PAIRED"
    video_raised = ~unpaired & F.coalesce("video_failed", F.lit(False))
    video_bad = ~unpaired & ~video_raised & F.col("video_reason").isNotNull()
    audio_raised = ~unpaired & ~video_raised & ~video_bad & F.coalesce("audio_failed", F.lit(False))
    audio_bad = ~unpaired & ~video_raised & ~video_bad & ~audio_raised & ~F.coalesce("audio_success", F.lit(False))
    u = u.withColumn("_end", F.when(unpaired | video_raised, 0).when(video_bad | audio_raised, 1).when(audio_bad, 2).otherwise(3))
    early = F.when(unpaired, F.col("pairing_status")).when(video_raised, "VIDEO_DECODE_FAILED").when(video_bad, F.col("video_reason")).when(audio_raised, "AUDIO_CONVERSION_FAILED").when(audio_bad, F.coalesce("audio_reason", F.lit("AUDIO_CONVERSION_FAILED")))
    found = F.array_sort(F.coalesce("detected", F.array().cast("array<int>")))
    u = u.withColumn("_found", found).withColumn("_n", F.coalesce("total_frames", F.lit(0)))
    measured = (F.col("_end") == 3) & (F.col("_n") > 0)
    u = u.withColumn("_ratio", F.when(measured, ratio(F.size("_found"), F.col("_n"))).otherwise(0.0)).withColumn("_run", F.when(measured, longest_run(F.col("_found"))).otherwise(0))
    late = reason(F.col("_n"), F.size("_found"), F.col("_ratio"), F.col("_run"), F.coalesce("readable", F.lit(False)), F.coalesce("has_audio", F.lit(False)), F.col("audio_sample_rate"), F.col("audio_duration_sec"), c)
    u = u.withColumn("invalid_reason", F.when(F.col("_end") == 3, late).otherwise(early))
    upto = lambda k, x, other: F.when(F.col("_end") >= k, x).otherwise(other)
    return u.select(
        "speaker_id", "utterance_id", F.col("invalid_reason").isNull().alias("valid"), "invalid_reason",
        upto(1, F.coalesce("source_fps", F.lit(0.0)), F.lit(0.0)).alias("source_fps"),
        upto(1, F.col("_n"), F.lit(0)).cast("int").alias("source_frame_count"),
        upto(2, F.size("_found"), F.lit(0)).cast("int").alias("cropped_frame_count"),
        F.col("_ratio").alias("face_detection_ratio"),
        F.col("_run").cast("int").alias("max_consecutive_face_frames"),
        upto(2, F.col("_found"), F.array().cast("array<int>")).alias("detected_frame_indices"),
        *[F.when(F.col("_end") == 3, F.col(x)).alias(x) for x in ("audio_duration_sec", "audio_sample_rate", "audio_channels")],
        F.when(F.col("_end") == 3, F.concat("speaker_id", F.lit("/"), "utterance_id", F.lit("/"))).otherwise("").alias("shard_member_prefix"),
    )


def spot_checked(frames: DataFrame, utterances: DataFrame, n: int = 3) -> DataFrame:
    """Whether the first n detected frames of each utterance(speaker_id, utterance_id, detected) are there and readable in
    frames(speaker_id, utterance_id, frame_index, readable)."""
    wanted = utterances.select("speaker_id", "utterance_id", F.explode(F.slice(F.array_sort("detected"), 1, n)).alias("frame_index"))
    return wanted.join(frames, ["speaker_id", "utterance_id", "frame_index"], "left").groupBy("speaker_id", "utterance_id").agg(F.bool_and(F.coalesce("readable", F.lit(False))).alias("readable"))


def reason_counts(records: DataFrame) -> DataFrame:
    """speaker_id, reason, n of invalid records, by speaker and reason, for a log."""
    bad = records.where(~F.col("valid")).groupBy("speaker_id", F.coalesce("invalid_reason", F.lit("UNKNOWN_ERROR")).alias("reason"))
    return bad.agg(F.count("*").alias("n")).orderBy("speaker_id", "reason")


def summarise(records: DataFrame) -> DataFrame:
    """speaker_id, total, valid, invalid, invalid_reason_counts (map; an invalid one without reason counts as UNKNOWN_ERROR)."""
    r = records.withColumn("reason", F.when(~F.col("valid"), F.coalesce("invalid_reason", F.lit("UNKNOWN_ERROR"))))
    by = r.groupBy("speaker_id", "reason").agg(F.count("*").alias("n"))
    bad = F.when(F.col("reason").isNotNull(), F.struct("reason", F.col("n").cast("int")))
    return by.groupBy("speaker_id").agg(
        F.sum("n").alias("total_candidates"), F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("valid_samples"),
        F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("n"))), F.lit(0)).alias("invalid_samples"), F.map_from_entries(F.array_sort(F.collect_list(bad))).alias("invalid_reason_counts"),
    )
