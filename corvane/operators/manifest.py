"""Manifest rows: parsing, ordered checks, uniqueness, eligibility, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.config import SPLITS
from corvane.errors import ManifestError
from corvane.functions.text import basename, strip, to_double, to_int
from corvane.operators.numbering import numbered
from corvane.schemas import MANIFEST_COLUMNS

SPEAKER = r"^s[1-9][0-9]*\z"
UTTERANCE = r"^[A-Za-z0-9_-]+\z"
INTS = ("frame_count", "first_frame_index", "last_frame_index", "audio_sample_rate")
DOUBLES = ("face_detection_ratio", "audio_duration_sec")


def missing_columns(df: DataFrame) -> list[str]:
    return sorted(set(MANIFEST_COLUMNS) - set(df.columns))


def speaker_ok(c: Column) -> Column:
    return c.rlike(SPEAKER) & (c != "s21")


def parsed(raw: DataFrame) -> DataFrame:
    """Manifest rows of strings as typed columns, `valid` as written (lower-cased), and error, the first check that fails or null. Other
    columns (a row number, say) stay. The expected split is the column `expected_split`."""
    missing = missing_columns(raw)
    if missing:
        raise ManifestError(f"the manifest lacks columns: {', '.join(missing)}")
    text = {c: strip(F.col(c)) for c in MANIFEST_COLUMNS if c not in INTS + DOUBLES}
    text["valid"] = F.lower(text["valid"])
    df = raw.withColumns(text | {f"_{c}": F.col(c) for c in INTS + DOUBLES}).withColumns({c: to_int(F.col(f"_{c}")) for c in INTS} | {c: to_double(F.col(f"_{c}")) for c in DOUBLES})
    absent = F.lit(None).cast("string")
    for c in reversed(MANIFEST_COLUMNS):
        absent = F.when(F.col(c).isNull(), f"invalid or missing value: {c}").otherwise(absent)
    n, first, last = F.col("frame_count"), F.col("first_frame_index"), F.col("last_frame_index")
    ratio = F.col("face_detection_ratio")
    checks = [
        (absent.isNotNull(), absent),
        (F.col("split") != F.col("expected_split"), F.concat(F.lit("unexpected split: "), F.col("split"))),
        (~speaker_ok(F.col("speaker_id")), F.concat(F.lit("invalid speaker: "), F.col("speaker_id"))),
        (~F.col("utterance_id").rlike(UTTERANCE), F.concat(F.lit("invalid utterance: "), F.col("utterance_id"))),
        (F.col("shard_member_prefix") != F.concat("speaker_id", F.lit("/"), "utterance_id", F.lit("/")), F.lit("wrong member prefix")),
        (basename(F.col("shard_path")) != F.concat("speaker_id", F.lit(".tar")), F.lit("wrong shard file name")),
        (~F.col("valid").isin("true", "1"), F.lit("not marked valid")),
        ((n < 1) | (first < 0) | (last < first) | (last.cast("bigint") - first + 1 < n), F.lit("frame indices and count disagree")),
        # not a number: a ratio fails, a duration passes here and fails when it is used
        (F.isnan(ratio) | ~ratio.between(0.0, 1.0) | (F.col("audio_duration_sec") <= 0) | (F.col("audio_sample_rate") <= 0), F.lit("invalid media values")),
    ]
    error = None
    for when, what in checks:
        error = F.when(when, what) if error is None else error.when(when, what)
    return df.withColumn("error", error).drop(*(f"_{c}" for c in INTS + DOUBLES))


def duplicates(rows: DataFrame) -> DataFrame:
    """(split, speaker, utterance) that occur more than once, with their number of rows."""
    return rows.groupBy("split", "speaker_id", "utterance_id").agg(F.count("*").alias("n")).where("n > 1")


def enforce(rows: DataFrame) -> DataFrame:
    """Valid rows only; raises on the first bad row by its file's split and row_number, then on a repeated utterance. One aggregate, one bounded lookup."""
    file = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("expected_split")).alias("file")
    bad = rows.where("error is not null").agg(F.min(F.struct(file, "row_number", "error")).alias("e")).first()["e"]
    if bad is not None:
        raise ManifestError(f"Manifest row {bad['row_number']}: {bad['error']}")
    twice = duplicates(rows).orderBy("split", "speaker_id", "utterance_id").take(1)
    if twice:
        raise ManifestError(f"Manifest repeats utterance {twice[0]['speaker_id']}/{twice[0]['utterance_id']}")
    return rows.drop("error")


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad ones with their error."""
    return rows.where("error is null").drop("error"), rows.where("error is not null")


def indexed(rows: DataFrame, by: str = "split") -> DataFrame:
    """With manifest_index, from 0 within each split (or other column) in file order, by ranges of a split: no task holds one whole. The rows are
    written to the checkpoint folder, where at() finds them by the index."""
    return numbered(rows, [F.col("row_number")], [by], "manifest_index").withColumn("manifest_index", F.col("manifest_index").cast("int"))


def eligible(rows: DataFrame, min_frame_count: int | None) -> DataFrame:
    """Rows with enough frames; None keeps all."""
    return rows if min_frame_count is None else rows.where(F.col("frame_count") >= min_frame_count)


def first(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; ranks are cut off before the shuffle too."""
    return rows.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_i") <= n).drop("_i")


def at(rows: DataFrame, split: str, index: int) -> DataFrame:
    """The row at a place of a split; negative ones count from its end."""
    if split not in SPLITS:
        raise ValueError(f"unknown split: {split!r}")
    mine = rows.where(F.col("split") == split)
    if index >= 0:
        return mine.where(F.col("manifest_index") == index)
    return mine.where(F.col("manifest_index") == mine.count() + index)


def overlapping_speakers(rows: DataFrame) -> DataFrame:
    """Speakers in more than one split."""
    return rows.groupBy("speaker_id").agg(F.count_distinct("split").alias("splits")).where("splits > 1")
