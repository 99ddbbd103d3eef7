"""The operators as queries over the given tables, with their SQL for DuckDB.

The corpus itself isn't among the tables, so each operator runs on a structural analogue: an order stands for an utterance,
l_linenumber for a frame's index, l_suppkey for a detector's view, sum(l_quantity) / 50 for seconds of audio, l_orderkey % 3 for a
split, % 7 for a speaker; documents and labels stand for video and audio files; events for the state log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.config import CorpusConfig
from corvane.functions.media import clamp_box, fps_ok, letterbox
from corvane.functions.runs import longest_run
from corvane.functions.text import archive_kind, basename, exact_mean, filename, folder, fmt_size, stem, strip, to_double, to_int
from corvane.operators import duration, gold, integrity, manifest, pairing, profile, quality, state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- analogues ----


def utterances(spark: SparkSession, d: str) -> DataFrame:
    li = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_linenumber").cast("int").alias("frame_count"), F.min("l_linenumber").alias("first_frame_index"), F.max("l_linenumber").alias("last_frame_index"), (F.sum("l_quantity") / 50).alias("audio_duration_sec"))
    key = F.col("l_orderkey")
    return li.select(F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (key % 3 + 1).cast("int")).alias("split"), F.concat(F.lit("s"), (key % 7 + 1).cast("string")).alias("speaker_id"), key.cast("string").alias("utterance_id"), "frame_count", "first_frame_index", "last_frame_index", "audio_duration_sec")


UTTERANCES = """u AS (SELECT ['train', 'val', 'test'][l_orderkey % 3 + 1] AS split, 's' || (l_orderkey % 7 + 1) AS speaker_id, l_orderkey::VARCHAR AS utterance_id, count(DISTINCT l_linenumber)::INT AS frame_count,
  min(l_linenumber) AS first_frame_index, max(l_linenumber) AS last_frame_index, sum(l_quantity) / 50 AS audio_duration_sec FROM lineitem GROUP BY l_orderkey)"""
GAPS = f"""{UTTERANCES},
v AS (SELECT *, (last_frame_index - first_frame_index + 1 - frame_count)::INT AS missing_frame_count, (last_frame_index - first_frame_index + 1) / 25.0::DOUBLE AS video_duration_sec FROM u),
w AS (SELECT *, video_duration_sec - audio_duration_sec AS duration_gap_sec, abs(video_duration_sec - audio_duration_sec) AS absolute_gap_sec FROM v),
g AS (SELECT *, absolute_gap_sec * 1000 > 80 AND NOT abs(absolute_gap_sec * 1000 - 80) <= 1e-9 AS exceeds_threshold FROM w)"""


@query(f"WITH {GAPS} SELECT split, speaker_id, utterance_id, frame_count, first_frame_index, last_frame_index, missing_frame_count, video_duration_sec, audio_duration_sec, duration_gap_sec, absolute_gap_sec, exceeds_threshold FROM g")
def gap_rows(spark, d):
    return duration.gaps(utterances(spark, d))


@query(
    f"""WITH {GAPS} SELECT CASE grouping(split, speaker_id) WHEN 3 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS level, CASE grouping(split, speaker_id) WHEN 3 THEN 'ALL' WHEN 1 THEN split ELSE split || '/' || speaker_id END AS "group",
split, speaker_id, count(*) AS utterances, sum(duration_gap_sec::DECIMAL(28, 9))::DOUBLE / count(*) AS mean_gap_sec, median(duration_gap_sec) AS median_gap_sec, min(duration_gap_sec) AS min_gap_sec, max(duration_gap_sec) AS max_gap_sec,
quantile_disc(absolute_gap_sec, 0.95) AS p95_absolute_gap_sec, count(*) FILTER (exceeds_threshold) AS exceeds_threshold_count, count(*) FILTER (exceeds_threshold) * 100.0::DOUBLE / count(*) AS exceeds_threshold_pct,
count(*) FILTER (missing_frame_count > 0) AS has_missing_frames_count FROM g GROUP BY GROUPING SETS ((), (split), (split, speaker_id))"""
)
def gap_summary(spark, d):
    return duration.summarise(duration.gaps(utterances(spark, d)))


@query("SELECT l_orderkey, CASE WHEN max(n) IS NULL THEN 0 ELSE max(n) END::INT AS longest_run FROM (SELECT l_orderkey, g, count(*) AS n FROM (SELECT l_orderkey, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) GROUP BY ALL) GROUP BY 1")
def longest_runs(spark, d):
    li = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("i"))
    return li.select("l_orderkey", longest_run(F.col("i")).alias("longest_run"))


PAIRS = """v AS (SELECT 's' || (doc_id // 10 % 7 + 1) AS speaker_id, max('/v/' || source || '/U' || (doc_id - doc_id % 10 // 9) || '.mpg') AS video_path, 'u' || (doc_id - doc_id % 10 // 9) AS utterance_id FROM documents WHERE doc_id % 5 <> 0 GROUP BY 1, 3),
a AS (SELECT 's' || (doc_id // 10 % 7 + 1) AS speaker_id, max('/a/' || quality || '/u' || (doc_id - doc_id % 10 // 9) || '.WAV') AS audio_path, 'u' || (doc_id - doc_id % 10 // 9) AS utterance_id FROM labels GROUP BY 1, 3),
p AS (SELECT speaker_id, utterance_id, video_path, audio_path, CASE WHEN audio_path IS NULL THEN 'MISSING_AUDIO' WHEN video_path IS NULL THEN 'MISSING_VIDEO' ELSE 'PAIRED' END AS pairing_status FROM v FULL JOIN a USING (speaker_id, utterance_id))"""


def pairs_of(spark, d):
    speaker = F.concat(F.lit("s"), (F.floor(F.col("doc_id") / 10) % 7 + 1).cast("string"))
    name = (F.col("doc_id") - F.when(F.col("doc_id") % 10 == 9, 1).otherwise(0)).cast("string")  # some twice
    v = t(spark, d, "documents").where("doc_id % 5 <> 0").select(speaker.alias("speaker_id"), F.concat(F.lit("/v/"), "source", F.lit("/U"), name, F.lit(".mpg")).alias("path"))
    a = t(spark, d, "labels").select(speaker.alias("speaker_id"), F.concat(F.lit("/a/"), F.col("quality").cast("string"), F.lit("/u"), name, F.lit(".WAV")).alias("path"))
    return pairing.pair(v, a)


@query(f"WITH {PAIRS} SELECT * FROM p")
def pairing_rows(spark, d):
    return pairs_of(spark, d)


@query(f"WITH {PAIRS} SELECT speaker_id, count(*) FILTER (pairing_status = 'PAIRED') AS paired, count(*) FILTER (pairing_status = 'MISSING_AUDIO') AS missing_audio, count(*) FILTER (pairing_status = 'MISSING_VIDEO') AS missing_video, 0::BIGINT AS duplicate_audio, 0::BIGINT AS duplicate_video FROM p GROUP BY 1")
def pairing_counts(spark, d):
    return pairing.counts(pairs_of(spark, d))


@query(f"WITH {PAIRS} SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY utterance_id) AS r FROM p WHERE pairing_status = 'PAIRED') WHERE r <= 5")
def pairing_limited(spark, d):
    return pairing.limited(pairs_of(spark, d), 5)


RECORDS = """e AS (SELECT event_id, user_id, value, json_extract_string(props, '$.k')::INT AS k, event_type FROM events),
q AS (SELECT 's' || (user_id % 7 + 1) AS speaker_id, event_id::VARCHAR AS utterance_id, CASE WHEN event_id % 11 = 0 THEN 'MISSING_AUDIO' WHEN event_id % 13 = 0 THEN 'VIDEO_DECODE_FAILED' WHEN event_id % 17 = 0 THEN 'INVALID_FPS' WHEN event_id % 19 = 0 THEN 'AUDIO_CONVERSION_FAILED'
  WHEN event_id % 23 = 0 THEN 'EMPTY_AUDIO' WHEN k % 12 = 0 THEN 'NO_FRAMES' WHEN k % 9 = 0 OR (k % 9)::DOUBLE / (k % 12) < 0.5 THEN 'FACE_NOT_DETECTED' WHEN k % 9 < 5 THEN 'INSUFFICIENT_CONSECUTIVE_FACE_FRAMES' WHEN event_id % 29 = 0 THEN 'CORRUPT_OUTPUT'
  WHEN event_id % 31 = 0 THEN 'AUDIO_DECODE_FAILED' WHEN event_type = 'click' THEN 'INVALID_OUTPUT_AUDIO_RATE' WHEN value < 0.1 THEN 'EMPTY_AUDIO' END AS invalid_reason,
  CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 0 WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN 1 WHEN event_id % 23 = 0 THEN 2 ELSE 3 END AS lvl, k, value, event_type FROM e)"""


def records_of(spark, d):
    e = t(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    hit = lambda n: F.col("event_id") % n == 0
    u = e.select(
        F.concat(F.lit("s"), (F.col("user_id") % 7 + 1).cast("string")).alias("speaker_id"), F.col("event_id").cast("string").alias("utterance_id"),
        F.when(hit(11), "MISSING_AUDIO").otherwise("PAIRED").alias("pairing_status"), hit(13).alias("video_failed"), F.when(hit(17), "INVALID_FPS").alias("video_reason"), F.lit(25.0).alias("source_fps"),
        (F.col("k") % 12).alias("total_frames"), F.when(F.col("k") % 9 > 0, F.sequence(F.lit(1), F.col("k") % 9)).otherwise(F.array().cast("array<int>")).alias("detected"), hit(19).alias("audio_failed"), (~hit(23)).alias("audio_success"),
        F.when(hit(23), "EMPTY_AUDIO").alias("audio_reason"), F.col("value").alias("audio_duration_sec"), F.when(F.col("event_type") == "click", 8000).otherwise(16000).alias("audio_sample_rate"), F.lit(1).alias("audio_channels"), (~hit(29)).alias("readable"), (~hit(31)).alias("has_audio"),
    )
    return quality.classify(u)


@query(
    f"""WITH {RECORDS} SELECT speaker_id, utterance_id, invalid_reason IS NULL AS valid, invalid_reason, CASE WHEN lvl >= 1 THEN 25.0::DOUBLE ELSE 0.0::DOUBLE END AS source_fps, CASE WHEN lvl >= 1 THEN k % 12 ELSE 0 END AS source_frame_count, CASE WHEN lvl >= 2 THEN k % 9 ELSE 0 END AS cropped_frame_count,
CASE WHEN lvl = 3 AND k % 12 > 0 THEN (k % 9)::DOUBLE / (k % 12) ELSE 0.0::DOUBLE END AS face_detection_ratio, CASE WHEN lvl = 3 AND k % 12 > 0 THEN k % 9 ELSE 0 END AS max_consecutive_face_frames, CASE WHEN lvl >= 2 THEN k % 9 ELSE 0 END AS n_indices,
CASE WHEN lvl = 3 THEN value END AS audio_duration_sec, CASE WHEN lvl = 3 THEN CASE event_type WHEN 'click' THEN 8000 ELSE 16000 END END AS audio_sample_rate, CASE WHEN lvl = 3 THEN 1 END AS audio_channels, CASE WHEN lvl = 3 THEN speaker_id || '/' || utterance_id || '/' ELSE '' END AS shard_member_prefix FROM q"""
)
def qc_records(spark, d):
    return records_of(spark, d).withColumn("n_indices", F.size("detected_frame_indices")).drop("detected_frame_indices")


@query(f"WITH {RECORDS} SELECT speaker_id, count(*) AS total_candidates, count(*) FILTER (invalid_reason IS NULL) AS valid_samples, count(invalid_reason) AS invalid_samples, count(DISTINCT invalid_reason) AS n_reasons, coalesce(count(*) FILTER (invalid_reason = 'NO_FRAMES'), 0)::INT AS no_frames FROM q GROUP BY 1")
def qc_summary(spark, d):
    s = quality.summarise(records_of(spark, d))
    return s.select("speaker_id", "total_candidates", "valid_samples", "invalid_samples", F.size("invalid_reason_counts").cast("bigint").alias("n_reasons"), F.coalesce(F.try_element_at("invalid_reason_counts", F.lit("NO_FRAMES")), F.lit(0)).alias("no_frames"))


RAW_SQL = """r AS (SELECT o_orderkey, o_orderkey + 2 AS row_number, ' train' AS split, CASE WHEN o_orderkey % 97 = 0 THEN 's21' WHEN o_orderkey % 89 = 0 THEN 's01' ELSE 's' || (o_custkey % 34 + 1) END AS sp, CASE WHEN o_orderkey % 83 = 0 THEN 'a/b' ELSE 'u' || o_orderkey END AS ut,
  CASE WHEN o_orderkey % 79 = 0 THEN 'x/' ELSE '' END AS px, CASE WHEN o_orderkey % 73 = 0 THEN 'False' WHEN o_orderkey % 2 = 0 THEN '1' ELSE 'True' END AS va, CASE WHEN o_orderkey % 71 = 0 THEN 'abc' WHEN o_orderkey % 67 = 0 THEN '99' ELSE '10' END AS fc,
  CASE WHEN o_orderkey % 61 = 0 THEN '1.5' ELSE '0.5' END AS ra, CASE WHEN o_orderkey % 59 = 0 THEN '1.0d' WHEN o_orderkey % 53 = 0 THEN '0' ELSE ' 1.25 ' END AS du FROM orders),
c AS (SELECT row_number, sp AS speaker_id, ut AS utterance_id, CASE WHEN fc = 'abc' THEN 'invalid or missing value: frame_count' WHEN du = '1.0d' THEN 'invalid or missing value: audio_duration_sec' WHEN NOT regexp_full_match(sp, 's[1-9][0-9]*') OR sp = 's21' THEN 'invalid speaker: ' || sp WHEN ut = 'a/b' THEN 'invalid utterance: a/b'
  WHEN px <> '' THEN 'wrong member prefix' WHEN va = 'False' THEN 'not marked valid' WHEN fc = '99' THEN 'frame indices and count disagree' WHEN ra = '1.5' OR du = '0' THEN 'invalid media values' END AS error FROM r)"""


def parsed_of(spark, d):
    k = F.col("o_orderkey")
    hit = lambda n: k % n == 0
    o = t(spark, d, "orders").withColumn("row_number", k + 2)
    sp = F.when(hit(97), "s21").when(hit(89), "s01").otherwise(F.concat(F.lit("s"), (F.col("o_custkey") % 34 + 1).cast("string")))
    ut = F.when(hit(83), "a/b").otherwise(F.concat(F.lit("u"), k.cast("string")))
    raw = o.select(
        "row_number", F.lit("train").alias("expected_split"), F.lit(" train").alias("split"), sp.alias("speaker_id"), ut.alias("utterance_id"), F.concat(F.lit("G:\\x\\"), sp, F.lit(".tar")).alias("shard_path"),
        F.concat(F.when(hit(79), "x/").otherwise(""), sp, F.lit("/"), ut, F.lit("/")).alias("shard_member_prefix"), F.when(hit(71), "abc").when(hit(67), "99").otherwise("10").alias("frame_count"), F.lit("0").alias("first_frame_index"), F.lit("74").alias("last_frame_index"),
        F.when(hit(61), "1.5").otherwise("0.5").alias("face_detection_ratio"), F.when(hit(59), "1.0d").when(hit(53), "0").otherwise(" 1.25 ").alias("audio_duration_sec"), F.lit("16000").alias("audio_sample_rate"), F.when(hit(73), "False").when(hit(2), "1").otherwise("True").alias("valid"),
    )
    return manifest.parsed(raw)


@query(f"WITH {RAW_SQL} SELECT * FROM c")
def manifest_checks(spark, d):
    return parsed_of(spark, d).select(F.col("row_number").cast("bigint"), "speaker_id", "utterance_id", "error")


@query(f"WITH {RAW_SQL} SELECT error, count(*) AS n, min(row_number) AS first_row FROM c WHERE error IS NOT NULL GROUP BY 1")
def manifest_quarantine(spark, d):
    _, bad = manifest.quarantine(parsed_of(spark, d))
    return bad.groupBy("error").agg(F.count("*").alias("n"), F.min("row_number").cast("bigint").alias("first_row"))


@query("SELECT 'all' AS split, o_custkey::VARCHAR AS speaker_id, o_orderpriority AS utterance_id, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def dup_keys(spark, d):
    return manifest.duplicates(t(spark, d, "orders").select(F.lit("all").alias("split"), F.col("o_custkey").cast("string").alias("speaker_id"), F.col("o_orderpriority").alias("utterance_id")))


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars >= 1000")
def eligible(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("n_chars").alias("frame_count"))
    return manifest.eligible(docs, 1000).withColumnRenamed("frame_count", "n_chars")


@query(f"WITH {UTTERANCES} SELECT split, speaker_id, utterance_id, row_number() OVER (PARTITION BY split ORDER BY utterance_id) - 1 AS manifest_index FROM u QUALIFY row_number() OVER (PARTITION BY split ORDER BY utterance_id DESC) = 1")
def ordinal_access(spark, d):
    rows = manifest.indexed(utterances(spark, d).withColumn("row_number", F.col("utterance_id")))
    out = manifest.at(rows, "train", -1).unionByName(manifest.at(rows, "val", -1)).unionByName(manifest.at(rows, "test", -1))
    return out.select("split", "speaker_id", "utterance_id", F.col("manifest_index").cast("bigint"))


@query(f"WITH {UTTERANCES} SELECT speaker_id, count(DISTINCT split) AS splits FROM u GROUP BY 1 HAVING count(DISTINCT split) > 1")
def overlapping_speakers(spark, d):
    return manifest.overlapping_speakers(utterances(spark, d))


SPLIT_VALUES = ", ".join(f"('{s}', '{k}')" for k, v in gold.split_speakers(CorpusConfig().usable(), 42, 27, 3, 3).items() for s in v)


@query(f"SELECT s_suppkey, x.speaker_id, x.split FROM supplier JOIN (VALUES {SPLIT_VALUES}) x(speaker_id, split) ON x.speaker_id = 's' || (s_suppkey % 34 + 1)")
def split_assign(spark, d):
    dim = gold.split_dimension(spark, CorpusConfig())
    s = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("s"), (F.col("s_suppkey") % 34 + 1).cast("string")).alias("speaker_id"))
    return s.join(dim.select("speaker_id", "split"), "speaker_id").select("s_suppkey", "speaker_id", "split")


GOLD_SQL = f"""li AS (SELECT l_orderkey, 's' || (l_orderkey % 34 + 1) AS speaker_id, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(DISTINCT l_linenumber)::INT AS n, bool_or(l_returnflag = 'R') AS bad, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
g AS (SELECT x.split, speaker_id, l_orderkey::VARCHAR AS utterance_id, CASE WHEN (l_orderkey % 34) % 2 = 0 THEN '/old/' || speaker_id || '.tar' ELSE './silver/shards/' || speaker_id || '.tar' END AS shard_path, speaker_id || '/' || l_orderkey || '/' AS shard_member_prefix, n AS frame_count, lo AS first_frame_index, hi AS last_frame_index,
  1.0::DOUBLE AS face_detection_ratio, q / 50 AS audio_duration_sec, 16000 AS audio_sample_rate, true AS valid FROM li JOIN (VALUES {SPLIT_VALUES}) x(speaker_id, split) USING (speaker_id) WHERE NOT bad)"""


def gold_of(spark, d):
    c = CorpusConfig()
    li = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("i"), F.bool_or(F.col("l_returnflag") == "R").alias("bad"), F.sum("l_quantity").alias("q"))
    sp = F.concat(F.lit("s"), (F.col("l_orderkey") % 34 + 1).cast("string"))
    uid = F.col("l_orderkey").cast("string")
    s = F.struct(uid.alias("utterance_id"), (~F.col("bad")).alias("valid"), F.size("i").alias("cropped_frame_count"), F.lit(1.0).alias("face_detection_ratio"), F.col("i").alias("detected_frame_indices"), (F.col("q") / 50).alias("audio_duration_sec"), F.lit(16000).alias("audio_sample_rate"), F.concat(sp, F.lit("/"), uid, F.lit("/")).alias("shard_member_prefix"))
    meta = li.groupBy(sp.alias("speaker_id")).agg(F.collect_list(s).alias("samples"))
    path = F.when((F.substring("speaker_id", 2, 9).cast("int") - 1) % 2 == 0, F.concat(F.lit("/old/"), "speaker_id", F.lit(".tar"))).otherwise("")
    meta = meta.withColumn("shard", F.struct(path.alias("path"))).withColumn("status", F.lit("DONE"))
    return gold.gold_rows(meta, gold.split_dimension(spark, c), c)


@query(f"WITH {GOLD_SQL} SELECT * FROM g")
def gold_project(spark, d):
    return gold_of(spark, d).drop("ordinal", "pos")


@query("SELECT 's' || i AS speaker_id FROM range(1, 35) r(i) WHERE i <> 21 AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 34 + 1 = i AND s_acctbal > 5000)")
def gold_incomplete(spark, d):
    sp = F.concat(F.lit("s"), (F.col("s_suppkey") % 34 + 1).cast("string"))
    meta = t(spark, d, "supplier").groupBy(sp.alias("speaker_id")).agg(F.when(F.max("s_acctbal") > 5000, "DONE").otherwise("QC").alias("status"))
    return gold.incomplete(gold.split_dimension(spark, CorpusConfig()), meta).select("speaker_id")


LOG_SQL = """l AS (SELECT user_id::VARCHAR AS speaker_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq, CASE event_id % 6 WHEN 0 THEN 'start' WHEN 1 THEN 'failure' WHEN 2 THEN 'done' ELSE 'transition' END AS kind,
  CASE event_id % 6 WHEN 1 THEN 'FAILED' WHEN 2 THEN 'DONE' WHEN 3 THEN 'QC' WHEN 4 THEN 'PACKAGING' WHEN 5 THEN 'UPLOADING' END AS status, event_id::VARCHAR AS ts, CASE WHEN event_id % 6 = 1 THEN event_type END AS error, CASE WHEN event_id % 6 = 2 THEN event_id END AS shard_size_bytes FROM events)"""


def log_of(spark, d):
    m = F.col("event_id") % 6
    e = t(spark, d, "events")
    e = e.withColumn("seq", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("bigint"))
    none = F.lit(None).cast("string")
    return e.select(
        F.col("user_id").cast("string").alias("speaker_id"), "seq", F.when(m == 0, "start").when(m == 1, "failure").when(m == 2, "done").otherwise("transition").alias("kind"),
        F.when(m == 1, "FAILED").when(m == 2, "DONE").when(m == 3, "QC").when(m == 4, "PACKAGING").when(m == 5, "UPLOADING").alias("status"), F.col("event_id").cast("string").alias("ts"), F.when(m == 1, F.col("event_type")).alias("error"),
        none.alias("shard_path"), none.alias("metadata_path"), F.when(m == 2, F.col("event_id")).alias("shard_size_bytes"), none.alias("shard_sha256"), none.alias("video_source_used"), none.alias("audio_source_used"),
    )


@query(
    f"""WITH {LOG_SQL}, b AS (SELECT *, coalesce(max(CASE WHEN kind = 'start' THEN seq END) OVER (PARTITION BY speaker_id), -1) AS s0 FROM l)
SELECT speaker_id, coalesce(arg_max(status, seq) FILTER (status IS NOT NULL), 'PENDING') AS status, count(*) FILTER (kind = 'start') AS attempt_count, arg_min(ts, seq) FILTER (seq >= s0 AND (kind = 'start' OR status NOT IN ('PENDING', 'DONE'))) AS started_at,
arg_max(ts, seq) FILTER (kind = 'done' AND seq >= s0) AS completed_at, (SELECT x.error FROM l x WHERE x.speaker_id = b.speaker_id AND x.kind IN ('start', 'done', 'failure') ORDER BY x.seq DESC LIMIT 1) AS last_error, arg_max(shard_size_bytes, seq) FILTER (shard_size_bytes IS NOT NULL) AS shard_size_bytes, max(seq) AS seq FROM b GROUP BY speaker_id"""
)
def state_latest(spark, d):
    return state.latest(log_of(spark, d)).select("speaker_id", "status", "attempt_count", "started_at", "completed_at", "last_error", "shard_size_bytes", "seq")


@query(f"WITH {LOG_SQL} SELECT speaker_id, seq, status, coalesce(lag(status) OVER (PARTITION BY speaker_id ORDER BY seq), 'PENDING') AS previous_status FROM l WHERE status IS NOT NULL")
def state_prev(spark, d):
    return state.transitions(log_of(spark, d)).select("speaker_id", "seq", "status", "previous_status")


@query(f"WITH {LOG_SQL}, s AS (SELECT speaker_id, arg_max(status, seq) FILTER (status IS NOT NULL) AS status FROM l GROUP BY 1) SELECT c_custkey::VARCHAR AS speaker_id, coalesce(status, 'PENDING') AS status, coalesce(status, 'PENDING') = 'DONE' AS is_done, coalesce(status, 'PENDING') <> 'DONE' AS should_retry FROM customer LEFT JOIN s ON speaker_id = c_custkey::VARCHAR")
def state_retry(spark, d):
    cat = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("speaker_id"))
    return state.with_retry(state.state(cat, log_of(spark, d))).select("speaker_id", "status", "is_done", "should_retry")


@query("SELECT s_suppkey::VARCHAR AS speaker_id, count(p_partkey) > 0 AND s_suppkey % 3 <> 0 AND coalesce(max(p_size) = s_suppkey % 50 + 1, false) AS verified FROM supplier LEFT JOIN part ON p_partkey = s_suppkey GROUP BY s_suppkey")
def artefacts_verified(spark, d):
    st = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("speaker_id"), (F.col("s_suppkey") % 50 + 1).alias("shard_size_bytes"), F.lit(None).cast("string").alias("shard_sha256"), F.lit("DONE").alias("status"))
    inv = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("speaker_id"), F.col("p_size").cast("bigint").alias("shard_size"), F.lit("x").alias("shard_sha"), (F.col("p_partkey") % 3 != 0).alias("has_metadata"))
    return state.verified(st, inv).select("speaker_id", "verified")


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def status_histogram(spark, d):
    return profile.status_histogram(t(spark, d, "events"), "event_type")


@query("SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text))::BIGINT AS size FROM documents")
def sha256(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    return integrity.with_digests(docs).select("doc_id", "sha256", "size")


@query(r"SELECT page_id, regexp_extract(url, '([^\\/]+)[\\/]*$', 1) AS base, lower(regexp_replace(regexp_extract(url, '([^/]+)/*$', 1), '(.)\.[^.]*$', '\1')) AS stem, regexp_extract(url, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(url, '([^/]*)$', 1) AS filename FROM pages")
def path_parts(spark, d):
    u = F.col("url")
    return t(spark, d, "pages").select("page_id", basename(u).alias("base"), stem(u).alias("stem"), folder(u).alias("folder"), filename(u).alias("filename"))


@query("SELECT doc_id, CASE WHEN regexp_full_match(source, 's[1-9][0-9]*') AND source <> 's21' THEN true ELSE false END AS speaker_ok, regexp_full_match(source, '[A-Za-z0-9_-]+') AS utterance_ok, regexp_full_match(source, 'src[1-9][0-9]*') AS source_ok FROM documents")
def id_regex(spark, d):
    s = F.col("source")
    return t(spark, d, "documents").select("doc_id", manifest.speaker_ok(s).alias("speaker_ok"), s.rlike(manifest.UTTERANCE).alias("utterance_ok"), s.rlike(r"^src[1-9][0-9]*\z").alias("source_ok"))


@query("SELECT o_orderkey, o_orderkey::INT AS as_int, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS as_double, o_orderpriority AS stripped FROM orders")
def tolerant_parse(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("\t"), k.cast("string"), F.lit(" \n"))).when(k % 3 == 1, F.concat(F.lit("+"), k.cast("string"))).otherwise(k.cast("string"))
    price = F.concat(F.col("o_totalprice").cast("string"), F.when(k % 5 == 0, "d").otherwise(" "))
    return t(spark, d, "orders").select("o_orderkey", to_int(text).alias("as_int"), to_double(price).alias("as_double"), strip(F.concat(F.lit("\t\x0b "), "o_orderpriority", F.lit("\r\n"))).alias("stripped"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, b."right" - b."left" AS w, b.bottom - b.top AS h FROM (SELECT *, struct_pack("left" := greatest(0, trunc(l_quantity - 10)::INT), top := greatest(0, trunc(l_discount * 100 - 3)::INT), "right" := least(40, trunc(l_quantity + l_tax * 100)::INT), bottom := least(8, trunc(l_tax * 100 + 2)::INT)) AS b FROM lineitem) WHERE b."right" > b."left" AND b.bottom > b.top"""
)
def box_clamp(spark, d):
    b = clamp_box(F.col("l_quantity") - 10, F.col("l_discount") * 100 - 3, F.col("l_quantity") + F.col("l_tax") * 100, F.col("l_tax") * 100 + 2, F.lit(40), F.lit(8))
    return t(spark, d, "lineitem").withColumn("b", b).where("b is not null").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("b.right") - F.col("b.left")).alias("w"), (F.col("b.bottom") - F.col("b.top")).alias("h"))


@query("WITH s AS (SELECT p_partkey, p_size, least(96.0::DOUBLE / p_size, 96.0::DOUBLE / (p_partkey % 37 + 1)) AS k FROM part), r AS (SELECT *, greatest(1, round_even(p_size * k, 0)::INT) AS width, greatest(1, round_even((p_partkey % 37 + 1) * k, 0)::INT) AS height FROM s) SELECT p_partkey, width, height, ((96 - width) // 2)::INT AS l, ((96 - height) // 2)::INT AS top FROM r")
def letterbox_geometry(spark, d):
    return t(spark, d, "part").withColumn("b", letterbox(F.col("p_size"), F.col("p_partkey") % 37 + 1, 96, 96)).select("p_partkey", "b.width", "b.height", F.col("b.left").alias("l"), "b.top")


@query("SELECT event_id, value BETWEEN 25.0 * 0.95 AND 25.0 * 1.05 AS ok FROM events")
def fps_gate(spark, d):
    return t(spark, d, "events").select("event_id", fps_ok(F.col("value"), 25.0, 0.05).alias("ok"))


@query("SELECT l_returnflag, sum(l_extendedprice::DECIMAL(28, 9))::DOUBLE / count(*) AS mean FROM lineitem GROUP BY 1")
def decimal_mean(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(exact_mean(F.col("l_extendedprice")).alias("mean"))


@query("SELECT 's' || (o_custkey % 7 + 1) AS speaker_id, o_orderkey::VARCHAR AS utterance_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def shard_missing(spark, d):
    valid = t(spark, d, "orders").select(F.concat(F.lit("s"), (F.col("o_custkey") % 7 + 1).cast("string")).alias("speaker_id"), F.col("o_orderkey").cast("string").alias("utterance_id"))
    k = F.col("l_orderkey").cast("string")
    speakers = valid.select("speaker_id", F.col("utterance_id").alias("k"))
    members = t(spark, d, "lineitem").select(k.alias("k")).join(speakers, "k").select("speaker_id", F.concat("speaker_id", F.lit("/"), "k", F.lit("/")).alias("prefix"))
    return integrity.missing_from_shards(valid, members)


@query("SELECT page_id, CASE WHEN url LIKE '%.html' THEN 'zip' END AS by_magic FROM pages")
def archive_kinds(spark, d):
    head = F.when(F.col("url").endswith(".html"), F.unhex(F.lit("504B0304"))).otherwise(F.unhex(F.lit("00")))
    return t(spark, d, "pages").select("page_id", archive_kind(F.lit("x.bin"), head).alias("by_magic"))


@query("SELECT n_nationkey, n_name FROM nation ORDER BY lower(n_name) LIMIT 12")
def top_preview(spark, d):
    e = t(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("name"), F.lit(False).alias("is_dir"))
    return profile.preview(e).select("n_nationkey", F.col("name").alias("n_name"))


