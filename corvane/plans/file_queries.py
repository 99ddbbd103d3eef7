"""The format's own files as queries: metadata, manifests, their description, reports and shards are written from the tables to a new corpus in the
shared folder, and read back by the sources.

A speaker's metadata are one JSON file and a split's manifest is one CSV file, as the format has them, so the longest of them grows with the
tables; tasks write and read them, and the driver holds a row for each of the 33 speakers.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.config import SPLITS, CorpusConfig, ReaderSettings
from corvane.operators import gold, integrity
from corvane.operators.numbering import shared_folder
from corvane.plans import corpus
from corvane.plans.catalogue import SPLIT_VALUES, query, t
from corvane.plans.more_queries import MEMBERS, packable
from corvane.schemas import DURATION, SUMMARY_COLUMNS
from corvane.sinks import files, shards
from corvane.sources import archive, manifest

#: Of the corpus that is built in part: a speaker whose metadata break off, and one who isn't done.
BROKEN, OPEN = "s5", "s7"


def corpus_of(spark: SparkSession, d: str, whole: bool = True) -> CorpusConfig:
    """A new corpus with metadata of all speakers, an order's lines being an utterance's frames. Unless it is whole, one file breaks off in its
    middle and one says that its speaker isn't done."""
    c = CorpusConfig(root=f"{re.sub('^file:/*', '/', shared_folder(spark))}/corvane-{uuid.uuid4().hex}")
    sp = F.concat(F.lit("s"), (F.col("l_orderkey") % 34 + 1).cast("string"))
    uid = F.col("l_orderkey").cast("string")
    orders = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("i"), (~F.bool_or(F.col("l_returnflag") == "R")).alias("valid"), F.sum("l_quantity").alias("q"))
    sample = F.struct(
        uid.alias("utterance_id"), "valid", F.size("i").alias("cropped_frame_count"), F.lit(1.0).alias("face_detection_ratio"), F.col("i").alias("detected_frame_indices"),
        (F.col("q") / 50).cast("double").alias("audio_duration_sec"), F.lit(16000).alias("audio_sample_rate"), F.concat(sp, F.lit("/"), uid, F.lit("/")).alias("shard_member_prefix"),
    )
    all_ = gold.split_dimension(spark, c).select("speaker_id", "ordinal")
    broken, open_ = (F.lit(not whole) & (F.col("speaker_id") == s) for s in (BROKEN, OPEN))
    items = orders.select(sp.alias("speaker_id"), uid.alias("place"), F.to_json(sample).alias("text")).join(F.broadcast(all_), "speaker_id", "left_semi").where(~broken)
    path = F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("/old/"), "speaker_id", F.lit(".tar"))).otherwise("")
    head = corpus.opening(F.to_json(F.struct("speaker_id", F.when(open_, "QC").otherwise("DONE").alias("status"))))
    tail = corpus.closing(F.to_json(F.struct(F.struct(path.alias("path")).alias("shard"))))
    files.long_documents(all_.select("speaker_id", head.alias("head"), F.when(broken, "").otherwise(tail).alias("tail")), items, c.metadata)
    corpus.build_gold(spark, c, allow_partial=not whole, clock=lambda: "now")
    return c


USABLE = "u AS (SELECT 's' || i AS speaker_id, row_number() OVER (ORDER BY i) - 1 AS ordinal FROM range(1, 35) r(i) WHERE i <> 21)"
ROWS = f"""{USABLE},
li AS (SELECT l_orderkey, 's' || (l_orderkey % 34 + 1) AS speaker_id, min(l_linenumber)::INT AS first_frame_index, max(l_linenumber)::INT AS last_frame_index, count(DISTINCT l_linenumber)::INT AS frame_count, bool_or(l_returnflag = 'R') AS bad, (sum(l_quantity) / 50)::DOUBLE AS audio_duration_sec FROM lineitem GROUP BY ALL),
m AS (SELECT split, speaker_id, l_orderkey::VARCHAR AS utterance_id, CASE WHEN ordinal % 2 = 0 THEN '/old/' ELSE '/silver/shards/' END || speaker_id || '.tar' AS shard_path, speaker_id || '/' || l_orderkey || '/' AS shard_member_prefix, frame_count, first_frame_index, last_frame_index,
  1.0::DOUBLE AS face_detection_ratio, audio_duration_sec, 16000 AS audio_sample_rate, true AS valid, (row_number() OVER (PARTITION BY split ORDER BY ordinal, l_orderkey::VARCHAR) - 1)::INT AS manifest_index
  FROM li JOIN u USING (speaker_id) JOIN (VALUES {SPLIT_VALUES}) x(speaker_id, split) USING (speaker_id) WHERE NOT bad)"""


@query(f"WITH {ROWS} SELECT * FROM m")
def gold_files(spark, d):
    """Metadata files, Gold built from them, and the manifests read and checked: rows in the order of speakers and samples."""
    c = corpus_of(spark, d)
    rows = manifest.load_all(spark, c.root).drop("row_number")
    return rows.withColumns({"shard_path": F.replace("shard_path", F.lit(c.root), F.lit("")), "valid": F.col("valid") == "true"})


@query(
    f"""WITH {ROWS}, x AS (SELECT * FROM (VALUES {SPLIT_VALUES}) x(speaker_id, split)), n AS (SELECT split, count(*) AS n, count(DISTINCT speaker_id) AS s FROM m WHERE speaker_id <> '{BROKEN}' GROUP BY 1)
SELECT x.split, count(DISTINCT x.speaker_id) AS speakers, coalesce(any_value(n.n), 0) AS described, coalesce(any_value(n.n), 0) AS utterances, coalesce(any_value(n.s), 0) AS with_rows, true AS partial, '{BROKEN},{OPEN}' AS missing FROM x LEFT JOIN n USING (split) GROUP BY 1"""
)
def partial_gold(spark, d):
    """Gold built in part: what its description says of each split, beside what its manifests hold. A speaker who isn't done counts as missing and
    has rows; one whose metadata can't be read has none."""
    c = corpus_of(spark, d, whole=False)
    m = json.loads(spark.read.text(f"{c.gold}/split_metadata.json", wholetext=True).first()[0])  # a file of fixed size
    said = spark.createDataFrame([(s, len(m[f"{s}_speakers"]), m["utterance_counts"][s], m["partial"], ",".join(m["missing_speakers"])) for s in SPLITS], "split string, speakers bigint, described bigint, partial boolean, missing string")
    held = manifest.load_all(spark, c.root, partial="partial").groupBy("split").agg(F.count("*").alias("utterances"), F.count_distinct("speaker_id").alias("with_rows"))
    return said.join(held, "split", "left").na.fill(0, ["utterances", "with_rows"])


GAP_ROWS = f"""{ROWS},
v AS (SELECT *, (last_frame_index - first_frame_index + 1 - frame_count)::INT AS missing_frame_count, (last_frame_index - first_frame_index + 1) / 25.0::DOUBLE AS video_duration_sec FROM m),
w AS (SELECT *, video_duration_sec - audio_duration_sec AS duration_gap_sec, abs(video_duration_sec - audio_duration_sec) AS absolute_gap_sec FROM v),
g AS (SELECT *, absolute_gap_sec * 1000 > 80 AND NOT abs(absolute_gap_sec * 1000 - 80) <= 1e-9 AS exceeds_threshold FROM w)"""


def reported(spark: SparkSession, d: str) -> dict[str, str]:
    c = corpus_of(spark, d)
    return corpus.report(spark, ReaderSettings(data_root=c.root), f"{c.root}/report")


@query(f"WITH {GAP_ROWS} SELECT {', '.join(DURATION.fieldNames())} FROM g")
def report_gaps(spark, d):
    """The report's file of utterances, read back: its numbers are those that were written, to the last bit."""
    return spark.read.schema(DURATION).option("header", True).csv(reported(spark, d)["utterance_gaps"])


@query(
    f"""WITH {GAP_ROWS}, f AS (SELECT split, speaker_id, min(manifest_index) AS first FROM g GROUP BY 1, 2),
s AS (SELECT grouping(split, speaker_id) AS level, split, speaker_id, count(*) AS utterances, sum(duration_gap_sec::DECIMAL(28, 9))::DOUBLE / count(*) AS mean_gap_sec, median(duration_gap_sec) AS median_gap_sec, min(duration_gap_sec) AS min_gap_sec, max(duration_gap_sec) AS max_gap_sec,
quantile_disc(absolute_gap_sec, 0.95) AS p95_absolute_gap_sec, count(*) FILTER (exceeds_threshold) AS exceeds_threshold_count, count(*) FILTER (exceeds_threshold) * 100.0::DOUBLE / count(*) AS exceeds_threshold_pct, count(*) FILTER (missing_frame_count > 0) AS has_missing_frames_count
FROM g GROUP BY GROUPING SETS ((), (split), (split, speaker_id)))
SELECT CASE level WHEN 0 THEN 'speaker_summary' ELSE 'split_summary' END AS file, row_number() OVER (PARTITION BY level = 0 ORDER BY CASE s.split WHEN 'train' THEN 1 WHEN 'val' THEN 2 WHEN 'test' THEN 3 ELSE 9 END, first) - 1 AS place,
CASE level WHEN 3 THEN 'ALL' WHEN 1 THEN s.split ELSE s.split || '/' || s.speaker_id END AS "group", utterances, mean_gap_sec, median_gap_sec, min_gap_sec, max_gap_sec, p95_absolute_gap_sec, exceeds_threshold_count, exceeds_threshold_pct, has_missing_frames_count
FROM s LEFT JOIN f ON level = 0 AND f.split = s.split AND f.speaker_id = s.speaker_id"""
)
def report_summaries(spark, d):
    """The report's two summaries, read back, with each row's place in its file: splits, then all; speakers by first appearance."""
    made = reported(spark, d)
    kind = lambda c: T.StringType() if c == "group" else T.LongType() if c == "utterances" or c.endswith("_count") else T.DoubleType()
    schema = T.StructType([T.StructField(c, kind(c)) for c in SUMMARY_COLUMNS])
    read = lambda name: spark.read.schema(schema).option("header", True).csv(made[name]).select(F.lit(name).alias("file"), F.monotonically_increasing_id().alias("place"), "*")
    return read("split_summary").unionByName(read("speaker_summary"))  # a file of 4 rows, and one of 33


@query(f"WITH {MEMBERS}, s AS (SELECT DISTINCT speaker_id FROM m) SELECT speaker_id, CASE speaker_id WHEN 's1' THEN 'size differs' WHEN 's2' THEN 'digest differs' ELSE 'missing' END AS problem FROM s WHERE speaker_id IN ('s1', 's2', 's3')")
def shards_verified(spark, d):
    """Packed shards read back from the store, against records of them of which one has another size, one another digest and one another path."""
    return shards.passed(packable(spark, d), problems)


def problems(info: DataFrame, _: str) -> DataFrame:
    one = lambda s: F.col("speaker_id") == s
    recorded = info.withColumns({"size": F.col("size") + F.when(one("s1"), 1).otherwise(0), "sha256": F.when(one("s2"), F.reverse("sha256")).otherwise(F.col("sha256")), "path": F.when(one("s3"), F.concat("path", F.lit(".gone"))).otherwise(F.col("path"))})
    return integrity.shard_problems(recorded, archive.digests(info)).join(recorded.select("path", "speaker_id"), "path").select("speaker_id", "problem")
