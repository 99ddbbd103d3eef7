"""Audio and video durations: gaps by utterance, and their statistics by group."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.errors import DatasetError
from corvane.functions.text import close, exact_mean, finite
from corvane.operators.numbering import kept, shared_folder
from corvane.operators.order_statistics import at_key_ranks, sortable
from corvane.schemas import DURATION


def fault(rows: DataFrame) -> Column:
    """Why a row's durations can't be had, or null."""
    n, first, last, audio = (F.col(c) for c in ("frame_count", "first_frame_index", "last_frame_index", "audio_duration_sec"))
    return F.when(n <= 0, "frame count isn't positive").when(last - first + 1 < n, "frame span is under the frame count").when(~finite(audio) | (audio <= 0), "audio duration isn't finite and positive")


def gaps(rows: DataFrame, fps: float = 25.0, threshold_ms: float = 80.0) -> DataFrame:
    """The span of frames decides the video's duration, not the number detected. A gap of the threshold itself, up to 1e-9 ms, doesn't
    exceed it."""
    if not (math.isfinite(fps) and fps > 0 and math.isfinite(threshold_ms) and threshold_ms >= 0):
        raise ValueError("fps must be positive and the threshold not negative, both finite")
    span = F.col("last_frame_index") - F.col("first_frame_index") + 1
    df = rows.withColumn("missing_frame_count", (span - F.col("frame_count")).cast("int")).withColumn("video_duration_sec", span / F.lit(float(fps)))
    df = df.withColumn("duration_gap_sec", F.col("video_duration_sec") - F.col("audio_duration_sec")).withColumn("absolute_gap_sec", F.abs("duration_gap_sec"))
    ms = F.col("absolute_gap_sec") * 1000.0
    df = df.withColumn("exceeds_threshold", (ms > threshold_ms) & ~close(ms, F.lit(float(threshold_ms))))
    return df.select(*DURATION.fieldNames())


def checked(rows: DataFrame) -> DataFrame:
    """rows, or an error for the first one whose durations can't be had."""
    bad = rows.withColumn("_fault", fault(rows)).where("_fault is not null").select("speaker_id", "utterance_id", "_fault").take(1)
    if bad:
        raise DatasetError(f"{bad[0]['speaker_id']}/{bad[0]['utterance_id']}: {bad[0]['_fault']}")
    return rows


def statistics() -> list[Column]:
    """A row's aggregates but for the order statistics. The mean sums decimals, so it is the same in any order of rows."""
    return [
        F.count("*").alias("utterances"),
        exact_mean(F.col("duration_gap_sec")).alias("mean_gap_sec"),
        F.min("duration_gap_sec").alias("min_gap_sec"),
        F.max("duration_gap_sec").alias("max_gap_sec"),
        F.count_if("exceeds_threshold").alias("exceeds_threshold_count"),
        (F.count_if("exceeds_threshold") * 100.0 / F.count("*")).alias("exceeds_threshold_pct"),
        F.count_if(F.col("missing_frame_count") > 0).alias("has_missing_frames_count"),
    ]


#: What names a group.
LEVELS = ["level", "split", "speaker_id"]


def summarise(rows: DataFrame, held: int = 1_000_000) -> DataFrame:
    """By split, by split and speaker, and over all. level: 0 all, 1 split, 2 speaker. Up to `held` rows are counted first: a group's values then fit
    in one buffer, and all is one aggregation over grouping sets. Of more rows the median and the 95th percentile (nearest rank) come
    from counts by their bits, so that no task holds a group's values. What is summarised is written to the shared folder once, in few columns, so
    that rows aren't made anew for each pass."""
    folder = f"{shared_folder(rows.sparkSession)}/corvane-{uuid.uuid4().hex}"
    rows = kept(rows.select("split", "speaker_id", "missing_frame_count", "duration_gap_sec", "absolute_gap_sec", "exceeds_threshold"), f"{folder}/gaps")
    few = rows.count() <= held
    buffered = [F.median("duration_gap_sec").alias("median_gap_sec"), F.expr("percentile_disc(0.95) within group (order by absolute_gap_sec)").alias("p95_absolute_gap_sec")]
    sets = rows.groupingSets([[], ["split"], ["split", "speaker_id"]], "split", "speaker_id").agg(F.grouping_id().alias("_g"), *statistics(), *(buffered if few else []))
    level = F.when(F.col("_g") == 3, 0).when(F.col("_g") == 1, 1).otherwise(2)
    # over no rows at all there is no group, not even the one over all
    sets = sets.where("utterances > 0").withColumn("level", level).drop("_g")
    if not few:
        sets = ordered(sets, rows, folder)
    group = F.when(F.col("level") == 0, "ALL").when(F.col("level") == 1, F.col("split")).otherwise(F.concat("split", F.lit("/"), "speaker_id"))
    names = ["utterances", "mean_gap_sec", "median_gap_sec", "min_gap_sec", "max_gap_sec", "p95_absolute_gap_sec", "exceeds_threshold_count", "exceeds_threshold_pct", "has_missing_frames_count"]
    return sets.select("level", group.alias("group"), "split", "speaker_id", *names)


def ordered(sets: DataFrame, rows: DataFrame, folder: str) -> DataFrame:
    """sets(level, split, speaker_id, ...) with the groups' order statistics, found by ranks. A row's two keys are written to the folder; it is told
    once for each level only where it is counted."""
    none = F.lit(None).cast("string")
    group = lambda level: F.struct(F.lit(level).alias("level"), (F.col("split") if level else none).alias("split"), (F.col("speaker_id") if level == 2 else none).alias("speaker_id"))
    metrics = F.array(F.struct(F.lit("gap").alias("of"), F.col("_gap").alias("_key")), F.struct(F.lit("absolute").alias("of"), F.col("_absolute").alias("_key")))
    keys = kept(rows.select("split", "speaker_id", sortable(F.col("duration_gap_sec")).alias("_gap"), sortable(F.col("absolute_gap_sec")).alias("_absolute")), f"{folder}/keys")
    each = keys.select("split", "speaker_id", F.explode(metrics).alias("m")).select(F.explode(F.array(*map(group, range(3)))).alias("g"), "m").select("g.*", "m.*").where("_key is not null")
    n = each.groupBy(*LEVELS, "of").agg(F.count("*").alias("n"))
    rank = F.array(
        F.struct(F.lit("gap").alias("of"), F.lit("low").alias("name"), F.floor((F.col("n") - 1) / 2).alias("rank")),
        F.struct(F.lit("gap").alias("of"), F.lit("high").alias("name"), F.floor(F.col("n") / 2).alias("rank")),
        F.struct(F.lit("absolute").alias("of"), F.lit("p95").alias("name"), (F.floor((F.col("n") * 95 + 99) / 100) - 1).alias("rank")),
    )
    ranks = n.select(*LEVELS, F.col("of").alias("mine"), F.explode(rank).alias("r")).where("mine = r.of").select(*LEVELS, "r.of", "r.name", "r.rank")
    found = at_key_ranks(each, ranks, [*LEVELS, "of"]).groupBy(*LEVELS).agg(*[F.max(F.when(F.col("name") == x, F.col("value"))).alias(x) for x in ("low", "high", "p95")])
    found = found.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], (0.5 * F.col("low") + 0.5 * F.col("high")).alias("median_gap_sec"), F.col("p95").alias("p95_absolute_gap_sec"))
    match = F.col("level") == F.col("_level")
    for c in LEVELS[1:]:
        match &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return sets.join(found, match, "left").drop(*(f"_{c}" for c in LEVELS))


def report_order(summary: DataFrame, rows: DataFrame) -> DataFrame:
    """Splits in their order, speakers by first appearance, all last."""
    split = F.coalesce(F.array_position(F.array(*map(F.lit, ("train", "val", "test"))), F.col("split")), F.lit(9))
    first = rows.groupBy("split", "speaker_id").agg(F.min("manifest_index").alias("_first"))
    return summary.join(first, ["split", "speaker_id"], "left").orderBy(F.when(F.col("level") == 0, 9).otherwise(split), F.col("_first").asc_nulls_first()).drop("_first")
