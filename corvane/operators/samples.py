"""Samples: manifest rows joined with their shards' members."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.media import decode_frames, decode_wav
from corvane.sources.members import content


def frame_lists(members: DataFrame) -> DataFrame:
    """speaker_id, prefix, frame_indices (ascending), repeats (an index twice, as 1.jpg and 01.jpg), has_audio for each folder with members."""
    frames = F.sort_array(F.collect_list("frame_index"))
    return members.groupBy("speaker_id", "prefix").agg(frames.alias("frame_indices"), F.bool_or(F.col("filename") == "audio.wav").alias("has_audio")).withColumn("repeats", F.size(F.array_distinct("frame_indices")) < F.size("frame_indices"))


def matched(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """Manifest rows with their folder's frames, and error: what doesn't agree first."""
    m = manifest.join(frame_lists(members).withColumnRenamed("prefix", "shard_member_prefix"), ["speaker_id", "shard_member_prefix"], "left")
    return m.withColumn("error", disagreement(F.col("frame_indices"), F.col("has_audio"), F.col("repeats")))


def disagreement(f: Column, has_audio: Column, repeats: Column) -> Column:
    """What frame indices f (ascending; null without a folder) and a manifest row don't agree on first; null if they agree."""
    return (
        F.when(f.isNull(), "utterance is missing from its shard")
        .when(~has_audio, "audio is missing")
        .when(F.size(f) == 0, "there are no frames")
        .when(repeats, "a frame index is there twice")
        .when(F.size(f) != F.col("frame_count"), "frame count differs from the manifest")
        .when(F.array_min(f) != F.col("first_frame_index"), "first frame differs from the manifest")
        .when(F.array_max(f) != F.col("last_frame_index"), "last frame differs from the manifest")
    )


def with_content(rows: DataFrame) -> DataFrame:
    """Members with content: rows of an index (sources.members) get theirs by ranged reads, others have it."""
    return rows if "content" in rows.columns else content(rows)


def frame(members: DataFrame, index: int) -> DataFrame:
    """speaker_id, prefix, content, error for each folder of members: the frame of that index, or that there is none. Names are looked through
    without content; of an index only this frame's bytes are read."""
    if index < 0:
        raise ValueError("a frame's index isn't negative")
    return _one(members, F.col("frame_index") == index, f"there is no frame {index}", f"frame {index} is there twice")


def audio(members: DataFrame) -> DataFrame:
    """speaker_id, prefix, content, error for each folder of members."""
    return _one(members, F.col("filename") == "audio.wav", "audio is missing", "audio is there twice")


def _one(members: DataFrame, which: Column, none: str, many: str) -> DataFrame:
    count = F.count_if(which).alias("n")
    if "content" in members.columns:
        # one scan: filters that one branch pushes to a Python source would reach the other too
        by = members.groupBy("speaker_id", "prefix").agg(count, F.first(F.when(which, F.col("content")), True).alias("content"))
        return by.select("speaker_id", "prefix", F.when(F.col("n") == 1, F.col("content")).alias("content"), F.when(F.col("n") == 0, none).when(F.col("n") > 1, many).alias("error"))
    by = members.groupBy("speaker_id", "prefix").agg(count)
    found = with_content(members.where(which)).select("speaker_id", "prefix", F.struct("content").alias("found"))
    # a folder that has it twice gets neither
    out = by.join(found, ["speaker_id", "prefix"], "left").groupBy("speaker_id", "prefix").agg(F.max("n").alias("n"), F.first(F.when(F.col("n") == 1, F.col("found")), True).alias("found"))
    return out.select("speaker_id", "prefix", F.col("found.content").alias("content"), F.when(F.col("n") == 0, none).when(F.col("n") > 1, many).alias("error"))


def utterances(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """Every manifest row with frames (map of index to bytes, ascending; null, and repeats true, if an index is there twice), audio, and
    error: what its shard lacks or what doesn't agree with it. Of an index the bytes of the manifest's own utterances are read. A row's size is bounded by one utterance, about
    75 frames."""
    mine = members.withColumnRenamed("prefix", "shard_member_prefix").join(manifest.select("speaker_id", "shard_member_prefix").distinct(), ["speaker_id", "shard_member_prefix"], "left_semi")
    wanted = F.col("frame_index").isNotNull() | (F.col("filename") == "audio.wav")
    # folders that have neither frames nor audio are there all the same
    there = mine.select("speaker_id", "shard_member_prefix").distinct()
    frames = F.sort_array(F.collect_list(F.when(F.col("frame_index").isNotNull(), F.struct("frame_index", "content"))))
    by = with_content(mine.where(wanted)).groupBy("speaker_id", "shard_member_prefix").agg(frames.alias("_frames"), F.first(F.when(F.col("filename") == "audio.wav", F.col("content")), True).alias("audio"))
    by = there.join(by, ["speaker_id", "shard_member_prefix"], "left").withColumn("_frames", F.coalesce("_frames", F.array().cast("array<struct<frame_index:int,content:binary>>")))
    by = by.withColumn("repeats", F.size(F.array_distinct("_frames.frame_index")) < F.size("_frames"))
    u = manifest.join(by, ["speaker_id", "shard_member_prefix"], "left")
    u = u.withColumn("error", disagreement(F.col("_frames.frame_index"), F.col("audio").isNotNull(), F.col("repeats")))
    return u.withColumn("frames", F.when(~F.col("repeats"), F.map_from_entries("_frames"))).drop("_frames")


def samples(manifest: DataFrame, members: DataFrame, fps: float = 25.0) -> DataFrame:
    """utterances() with samples of audio, video and audio durations, their gap, and error; rows with an error have no gap."""
    u = utterances(manifest, members).withColumn("_a", decode_wav("audio", "audio_sample_rate"))
    u = u.withColumns({"samples": F.col("_a.samples"), "error": F.coalesce("error", "_a.error")}).drop("_a", "audio", "repeats")
    u = u.withColumn("video_duration_sec", (F.col("last_frame_index") - F.col("first_frame_index") + 1) / F.lit(float(fps)))
    u = u.withColumn("decoded_audio_sec", F.when(F.col("samples").isNotNull() & F.col("error").isNull(), F.size("samples") / F.col("audio_sample_rate")))
    return u.withColumn("duration_gap_sec", F.col("video_duration_sec") - F.col("decoded_audio_sec")).withColumn("gap_warning", F.abs("duration_gap_sec") > 0.08)


def with_pixels(rows: DataFrame, decoder: Callable, width: int = 96, height: int = 96) -> DataFrame:
    """samples() with pixels: a map of frame index to height x width x 3 bytes, ascending, instead of frames; a frame that can't be decoded is the
    row's error, which then has no pixels. decoder as functions.media.decode_frames takes it."""
    frames = rows.where("error is null").select(F.concat_ws("\n", "speaker_id", "shard_member_prefix").alias("prefix"), F.explode("frames").alias("frame_index", "content"))
    decoded = decode_frames(frames, decoder, width, height)
    bad = F.min_by(F.concat(F.lit("frame "), F.col("frame_index").cast("string"), F.lit(": "), F.col("error")), F.when(F.col("error").isNotNull(), F.col("frame_index")))
    by = decoded.groupBy("prefix").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("frame_index", "pixels")))).alias("_pixels"), bad.alias("_bad"))
    out = rows.drop("frames").withColumn("prefix", F.concat_ws("\n", "speaker_id", "shard_member_prefix")).join(by, "prefix", "left").drop("prefix")
    return out.withColumns({"pixels": F.when(F.col("_bad").isNull() & F.col("error").isNull(), F.col("_pixels")), "error": F.coalesce("error", "_bad")}).drop("_pixels", "_bad")
