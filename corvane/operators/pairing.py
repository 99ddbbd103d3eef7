"""Pairing of video and audio files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.config import PAIRING
from corvane.errors import SourceLayoutError
from corvane.functions.text import stem
from corvane.operators.manifest import first


def keyed(files: DataFrame) -> DataFrame:
    """One path for each (speaker, lower-cased stem) of files(speaker_id, path): the greatest, and how many there were."""
    return files.withColumn("utterance_id", stem(F.col("path"))).groupBy("speaker_id", "utterance_id").agg(F.max("path").alias("path"), F.count("*").alias("n"))


def pair(videos: DataFrame, audios: DataFrame, strict: bool = False, check: bool = True) -> DataFrame:
    """speaker_id, utterance_id, video_path, audio_path, pairing_status for files(speaker_id, path) of either kind. strict marks
    utterances with several files; otherwise one is taken. check raises if either side has no files."""
    if check:
        for name, side in (("video", videos), ("audio", audios)):
            if not side.take(1):
                raise SourceLayoutError(f"there are no {name} files")
    v = keyed(videos).withColumnsRenamed({"path": "video_path", "n": "n_video"})
    a = keyed(audios).withColumnsRenamed({"path": "audio_path", "n": "n_audio"})
    status = F.when(F.col("audio_path").isNull(), "MISSING_AUDIO").when(F.col("video_path").isNull(), "MISSING_VIDEO")
    if strict:
        status = status.when(F.col("n_audio") > 1, "DUPLICATE_AUDIO").when(F.col("n_video") > 1, "DUPLICATE_VIDEO")
    return v.join(a, ["speaker_id", "utterance_id"], "full_outer").select("speaker_id", "utterance_id", "video_path", "audio_path", status.otherwise("PAIRED").alias("pairing_status"))


def layout_faults(speakers: DataFrame, videos: DataFrame, audios: DataFrame) -> DataFrame:
    """speaker_id, error for speakers that have no video files or no audio files."""
    has = lambda files, name: files.select("speaker_id").distinct().withColumn(name, F.lit(True))
    df = speakers.select("speaker_id").join(has(videos, "_v"), "speaker_id", "left").join(has(audios, "_a"), "speaker_id", "left")
    error = F.when(F.col("_v").isNull(), "there are no video files").when(F.col("_a").isNull(), "there are no audio files")
    return df.select("speaker_id", error.alias("error")).where("error is not null")


def counts(pairs: DataFrame) -> DataFrame:
    """A column of counts for each status, by speaker."""
    return pairs.groupBy("speaker_id").agg(*[F.count_if(F.col("pairing_status") == s).alias(s.lower()) for s in PAIRING])


def limited(pairs: DataFrame, n: int | None) -> DataFrame:
    """The first n paired utterances of each speaker; all pairs without n."""
    if not n:
        return pairs
    return first(pairs.where("pairing_status = 'PAIRED'"), ["speaker_id"], ["utterance_id"], n)
