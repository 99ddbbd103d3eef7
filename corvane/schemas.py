"""Schemas of everything that is read or written."""

from pyspark.sql import types as T


TYPES = {"STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "BINARY": T.BinaryType(), "INTS": T.ArrayType(T.IntegerType())}


def _schema(text: str, **more: T.DataType) -> T.StructType:
    """From names and types, without a session; types named in `more` are given there."""
    return T.StructType([T.StructField(n, (TYPES | more)[k]) for n, k in (x.split(" ") for x in text.split(", "))])


MANIFEST_COLUMNS = ("split", "speaker_id", "utterance_id", "shard_path", "shard_member_prefix", "frame_count", "first_frame_index", "last_frame_index", "face_detection_ratio", "audio_duration_sec", "audio_sample_rate", "valid")
SAMPLE = _schema("utterance_id STRING, valid BOOLEAN, invalid_reason STRING, source_fps DOUBLE, source_frame_count INT, cropped_frame_count INT, face_detection_ratio DOUBLE, max_consecutive_face_frames INT, detected_frame_indices INTS, audio_duration_sec DOUBLE, audio_sample_rate INT, audio_channels INT, shard_member_prefix STRING")
METADATA = _schema(
    "schema_version STRING, dataset STRING, speaker_id STRING, status STRING, source SOURCE, processing PROCESSING, summary SUMMARY, invalid_reason_counts COUNTS, samples SAMPLES, shard SHARD, generated_at STRING",
    SOURCE=_schema("video_source_used STRING, audio_source_used STRING"),
    PROCESSING=_schema("expected_fps DOUBLE, target_audio_sample_rate INT, min_face_detection_ratio DOUBLE, min_consecutive_face_frames INT"),
    SUMMARY=_schema("total_candidates INT, valid_samples INT, invalid_samples INT"),
    COUNTS=T.MapType(T.StringType(), T.IntegerType()),
    SAMPLES=T.ArrayType(SAMPLE),
    SHARD=_schema("path STRING, size_bytes BIGINT, sha256 STRING"),
)
MEMBER = _schema("speaker_id STRING, prefix STRING, filename STRING, frame_index INT, size BIGINT, offset BIGINT, content BINARY")
EVENT = _schema("speaker_id STRING, seq BIGINT, kind STRING, status STRING, ts STRING, error STRING, shard_path STRING, metadata_path STRING, shard_size_bytes BIGINT, shard_sha256 STRING, video_source_used STRING, audio_source_used STRING")
DURATION = _schema("split STRING, speaker_id STRING, utterance_id STRING, frame_count INT, first_frame_index INT, last_frame_index INT, missing_frame_count INT, video_duration_sec DOUBLE, audio_duration_sec DOUBLE, duration_gap_sec DOUBLE, absolute_gap_sec DOUBLE, exceeds_threshold BOOLEAN")
SUMMARY_COLUMNS = ("group", "utterances", "mean_gap_sec", "median_gap_sec", "min_gap_sec", "max_gap_sec", "p95_absolute_gap_sec", "exceeds_threshold_count", "exceeds_threshold_pct", "has_missing_frames_count")
