"""Further operators as queries, with their SQL, on analogues as in catalogue.py: members of shards and their readers, profiles, choices of
sources, decisions about what to process, documents by speaker, decoded audio."""

from __future__ import annotations

import re
import shutil
import uuid

from pyspark.sql import functions as F

from corvane.config import CorpusConfig
from corvane.functions.media import decode_wav
from corvane.functions.text import fmt_size, human_bytes, round4
from corvane.operators import gold, manifest, pairing, profile, quality, samples, state
from corvane.operators.numbering import settled, shared_folder
from corvane.plans import corpus
from corvane.plans.catalogue import GOLD_SQL, RECORDS, gold_of, query, records_of, t
from corvane.sinks import files, shards
from corvane.sources import members, metadata

# ---- shards' members ----

MEMBERS = """m AS (SELECT 's' || (l_orderkey % 7 + 1) AS speaker_id, 's' || (l_orderkey % 7 + 1) || '/' || l_orderkey || '/' AS prefix, l_linenumber || '.jpg' AS filename, l_linenumber AS frame_index, l_partkey::VARCHAR AS content FROM lineitem WHERE l_orderkey % 13 <> 0 AND l_orderkey % 19 <> 0
  UNION ALL SELECT 's' || (l_orderkey % 7 + 1), 's' || (l_orderkey % 7 + 1) || '/' || l_orderkey || '/', 'audio.wav', NULL, 'wav' || l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 13 <> 0 AND l_orderkey % 17 <> 0)),
f AS (SELECT speaker_id, prefix, list_sort(coalesce(list(frame_index) FILTER (frame_index IS NOT NULL), [])) AS i, bool_or(filename = 'audio.wav') AS has_audio FROM m GROUP BY ALL)"""


def members_of(spark, d):
    k = F.col("l_orderkey")
    sp = F.concat(F.lit("s"), (k % 7 + 1).cast("string"))
    li = t(spark, d, "lineitem").where(k % 13 != 0).withColumn("speaker_id", sp).withColumn("prefix", F.concat("speaker_id", F.lit("/"), k.cast("string"), F.lit("/")))
    frames = li.where(k % 19 != 0).select("speaker_id", "prefix", F.concat(F.col("l_linenumber").cast("string"), F.lit(".jpg")).alias("filename"), F.col("l_linenumber").cast("int").alias("frame_index"), F.col("l_partkey").cast("string").cast("binary").alias("content"))
    audio = li.where(k % 17 != 0).select("speaker_id", "prefix", F.lit("audio.wav").alias("filename"), F.lit(None).cast("int").alias("frame_index"), F.concat(F.lit("wav"), k.cast("string")).cast("binary").alias("content")).distinct()
    return frames.unionByName(audio)


@query(f"WITH {MEMBERS} SELECT speaker_id, prefix, array_to_string(i, ',') AS frames, has_audio, len(list_distinct(i)) < len(i) AS repeats FROM f")
def frames_listed(spark, d):
    return samples.frame_lists(members_of(spark, d)).select("speaker_id", "prefix", F.array_join(F.col("frame_indices").cast("array<string>"), ",").alias("frames"), "has_audio", "repeats")


@query(
    f"""WITH {MEMBERS}, g AS (SELECT l_orderkey AS k, 's' || (l_orderkey % 7 + 1) AS speaker_id, 's' || (l_orderkey % 7 + 1) || '/' || l_orderkey || '/' AS prefix, count(*) + CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END AS n, min(l_linenumber) + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS lo,
  max(l_linenumber) + CASE WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END AS hi FROM lineitem GROUP BY 1)
SELECT speaker_id, k::VARCHAR AS utterance_id, CASE WHEN i IS NULL THEN 'utterance is missing from its shard' WHEN NOT has_audio THEN 'audio is missing' WHEN len(i) = 0 THEN 'there are no frames' WHEN len(list_distinct(i)) < len(i) THEN 'a frame index is there twice' WHEN len(i) <> n THEN 'frame count differs from the manifest'
  WHEN i[1] <> lo THEN 'first frame differs from the manifest' WHEN i[-1] <> hi THEN 'last frame differs from the manifest' END AS error FROM g LEFT JOIN f USING (speaker_id, prefix)"""
)
def sample_errors(spark, d):
    k = F.col("l_orderkey")
    one = lambda n: F.when(k % n == 0, 1).otherwise(0)
    g = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    sp = F.concat(F.lit("s"), (k % 7 + 1).cast("string"))
    m = g.select(sp.alias("speaker_id"), k.cast("string").alias("utterance_id"), F.concat(sp, F.lit("/"), k.cast("string"), F.lit("/")).alias("shard_member_prefix"), (F.col("n") + one(5)).alias("frame_count"), (F.col("lo") + one(3)).alias("first_frame_index"), (F.col("hi") + one(11)).alias("last_frame_index"))
    return samples.matched(m, members_of(spark, d)).select("speaker_id", "utterance_id", "error")


@query(f"WITH {MEMBERS} SELECT speaker_id, prefix, CASE WHEN count(*) FILTER (frame_index = 2) = 1 THEN any_value(content) FILTER (frame_index = 2) END AS content, CASE count(*) FILTER (frame_index = 2) WHEN 0 THEN 'there is no frame 2' WHEN 1 THEN NULL ELSE 'frame 2 is there twice' END AS error FROM m GROUP BY ALL")
def frame_read(spark, d):
    return samples.frame(members_of(spark, d), 2).withColumn("content", F.col("content").cast("string"))


@query(f"WITH {MEMBERS} SELECT speaker_id, prefix, any_value(content) FILTER (filename = 'audio.wav') AS content, CASE WHEN count(*) FILTER (filename = 'audio.wav') = 0 THEN 'audio is missing' END AS error FROM m GROUP BY ALL")
def audio_read(spark, d):
    return samples.audio(members_of(spark, d)).withColumn("content", F.col("content").cast("string"))


@query(f"WITH {MEMBERS} SELECT speaker_id, prefix, CASE WHEN count(*) FILTER (frame_index = 2) = 1 THEN any_value(content) FILTER (frame_index = 2) END AS content, CASE count(*) FILTER (frame_index = 2) WHEN 0 THEN 'there is no frame 2' WHEN 1 THEN NULL ELSE 'frame 2 is there twice' END AS error FROM m GROUP BY ALL")
def shard_frame_read(spark, d):
    """The same from real shards: packed from the table, indexed by their headers, one frame of each utterance read by its place."""
    read = lambda _, folder: samples.frame(members.of_folder(spark, folder, table=f"{folder}-index"), 2)
    return shards.passed(packable(spark, d), read).withColumn("content", F.col("content").cast("string"))


@query(f"WITH {MEMBERS} SELECT speaker_id, count(*) AS members, ((sum(512 + (length(content) + 511) // 512 * 512) + 1024 + 10239) // 10240 * 10240)::BIGINT AS size FROM m GROUP BY 1")
def shards_packed(spark, d):
    """A tar's length follows from its members': a block for each header, whole blocks of content, and the end to whole records."""
    return shards.passed(packable(spark, d), lambda info, _: info.select("speaker_id", "members", "size"))


def packable(spark, d):
    return members_of(spark, d).select("speaker_id", F.element_at(F.split("prefix", "/"), 2).alias("utterance_id"), "filename", "content")


#: A WAV file's head for 64 mono 16-bit samples at 16 kHz (fixed values of the format).
HEAD = "52494646A400000057415645666D74201000000001000100803E0000007D0000020010006461746180000000"


@query("SELECT vec_id, unnest(range(64))::INT AS i, unnest(list_transform(embedding[:64], lambda x: (trunc(x * 1000)::INT / 32768.0::DOUBLE)))::FLOAT AS sample FROM embeddings")
def wav_decoded(spark, d):
    word = F.transform(F.slice("embedding", 1, 64), lambda x: F.lpad(F.hex((F.floor(F.abs(x.cast("float") * F.lit(1000.0).cast("float"))).cast("int") * F.signum(x.cast("double")).cast("int")).bitwiseAND(F.lit(65535))), 4, "0"))
    data = F.unhex(F.concat(F.lit(HEAD), F.array_join(F.transform(word, lambda w: F.concat(F.substring(w, 3, 2), F.substring(w, 1, 2))), "")))
    e = t(spark, d, "embeddings").select("vec_id", decode_wav(data, F.lit(16000)).alias("a"))
    return e.select("vec_id", F.posexplode("a.samples").alias("i", "sample"))


# ---- profiles ----

FILES = "f AS (SELECT '/x/' || source || '/S' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '.zip' ELSE '.tar' END AS path, n_chars AS size FROM documents)"


def files_of(spark, d):
    ext = F.when(F.col("doc_id") % 3 == 0, ".zip").otherwise(".tar")
    return t(spark, d, "documents").select(F.concat(F.lit("/x/"), "source", F.lit("/S"), F.col("doc_id").cast("string"), ext).alias("path"), F.col("n_chars").alias("size"))


@query(f"WITH {FILES} SELECT count(*) AS shards, sum(size)::BIGINT AS bytes FROM f WHERE path LIKE '%.tar'")
def shard_totals(spark, d):
    return profile.shard_totals(files_of(spark, d))


@query(f"WITH {FILES} SELECT regexp_extract(path, '([^/]+)$', 1) AS name, size FROM f WHERE path LIKE '%.tar' ORDER BY lower(regexp_extract(path, '([^/]+)$', 1)) LIMIT 40")
def shard_inventory(spark, d):
    return profile.shard_inventory(files_of(spark, d))


def json_of(spark, d):
    k, none = F.col("event_id"), F.lit(None)
    doc = F.struct(F.col("event_type").alias("status"), (k % 50).alias("seed"), F.when(k % 2 == 0, F.array(F.struct(F.lit(1).alias("b"), k.alias("a")))).alias("samples"), F.when(k % 3 == 0, F.struct(k.alias("train"), F.lit("x").alias("note"), (k % 2 == 0).alias("whole"))).alias("summary"))
    broken = F.when(k % 7 == 0, "{bad").when(k % 11 == 0, "[1]").otherwise(F.to_json(doc))
    return t(spark, d, "events").select(k.cast("string").alias("path"), broken.alias("json"), none.alias("_")).drop("_")


@query(
    """SELECT event_id::VARCHAR AS path, event_id % 7 <> 0 AS readable, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'samples,' ELSE '' END || 'seed,status' || CASE WHEN event_id % 3 = 0 THEN ',summary' ELSE '' END END AS root_keys,
CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN event_type END AS status, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN (event_id % 50)::VARCHAR END AS seed, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 2 = 0 THEN '1' END AS samples,
CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 2 = 0 THEN 'a,b' END AS sample_keys FROM events"""
)
def json_profiles(spark, d):
    p = profile.json_profile(json_of(spark, d))
    return p.select("path", "readable", F.array_join("root_keys", ",").alias("root_keys"), "status", "seed", F.col("samples").cast("string").alias("samples"), F.array_join("sample_keys", ",").alias("sample_keys"))


@query("SELECT event_id::VARCHAR AS path, 'summary' AS key, 'note,train,whole' AS keys, 2::BIGINT AS n_numbers, event_id::VARCHAR AS train FROM events WHERE event_id % 3 = 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0")
def json_numbers(spark, d):
    o = profile.json_objects(json_of(spark, d))
    return o.select("path", "key", F.array_join("keys", ",").alias("keys"), F.size("numbers").cast("bigint").alias("n_numbers"), F.col("numbers")["train"].alias("train"))


@query("SELECT page_id, CASE WHEN x < 1024 THEN format('{:.2f} B', x) WHEN x < 1048576 THEN format('{:.2f} KiB', x / 1024) WHEN x < 1073741824 THEN format('{:.2f} MiB', x / 1048576) ELSE format('{:.2f} GiB', x / 1073741824) END AS size FROM (SELECT page_id, (page_id * page_id * 977 % 5000000000)::DOUBLE AS x FROM pages)")
def human_sizes(spark, d):
    p = F.col("page_id")
    return t(spark, d, "pages").select("page_id", human_bytes((p * p * 977 % 5000000000).cast("double")).alias("size"))


@query("SELECT doc_id, CASE WHEN x < 1024 THEN format('{:,.1f} B', x) WHEN x < 1048576 THEN format('{:,.1f} KiB', x / 1024) ELSE format('{:,.1f} MiB', x / 1048576) END AS size FROM (SELECT doc_id, (n_chars * (doc_id % 900 + 1))::DOUBLE AS x FROM documents)")
def size_text(spark, d):
    return t(spark, d, "documents").select("doc_id", fmt_size(F.col("n_chars") * (F.col("doc_id") % 900 + 1)).alias("size"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_linenumber / (l_partkey % 64 + 1.0::DOUBLE), 4) AS ratio FROM lineitem")
def rounded_ratios(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", round4(F.col("l_linenumber") / (F.col("l_partkey") % 64 + 1.0)).alias("ratio"))


# ---- sources and decisions ----


@query(
    """WITH a AS (SELECT o_custkey::VARCHAR AS speaker_id, CASE WHEN o_orderkey % 2 = 0 THEN 'video' ELSE 'audio' END AS kind, CASE WHEN o_orderkey % 3 = 0 THEN 'primary' ELSE 'fallback' END AS source, max(o_orderkey)::VARCHAR AS url, max(o_orderkey) % 5 <> 0 AS verified FROM orders GROUP BY 1, 2, 3),
k AS (SELECT c_custkey::VARCHAR AS speaker_id, unnest(['video', 'audio']) AS kind FROM customer),
j AS (SELECT k.*, p.url AS p, f.url AS f, CASE WHEN k.kind = 'audio' THEN 'all' END AS s FROM k LEFT JOIN a p ON p.speaker_id = k.speaker_id AND p.kind = k.kind AND p.source = 'primary' AND p.verified LEFT JOIN a f ON f.speaker_id = k.speaker_id AND f.kind = k.kind AND f.source = 'fallback' AND f.verified)
SELECT speaker_id, kind, CASE WHEN p IS NOT NULL THEN 'primary' WHEN coalesce(f, s) IS NOT NULL THEN 'zenodo_fallback' END AS source, coalesce(p, f, s) AS url FROM j"""
)
def sources_chosen(spark, d):
    o = F.col("o_orderkey")
    kind, source = F.when(o % 2 == 0, "video").otherwise("audio"), F.when(o % 3 == 0, "primary").otherwise("fallback")
    a = t(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("speaker_id"), kind.alias("kind"), source.alias("source")).agg(F.max("o_orderkey").alias("k"))
    a = a.select("speaker_id", "kind", "source", F.col("k").cast("string").alias("url"), (F.col("k") % 5 != 0).alias("verified"))
    shared = spark.createDataFrame([(None, "audio", "fallback", "all", True)], a.schema)
    return metadata.chosen_sources(t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("speaker_id")), a.unionByName(shared))


@query("SELECT p_name || '-' || p_partkey AS filename, p_brand AS url FROM part UNION ALL SELECT p_type || '-' || p_partkey, 'd' || p_partkey FROM part WHERE p_partkey % 3 <> 0")
def file_listing(spark, d):
    p = F.col("p_partkey").cast("string")
    second = F.struct(F.lit("").alias("key"), F.concat("p_type", F.lit("-"), p).alias("filename"), F.struct(F.lit("").alias("self"), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("d"), p)).alias("download")).alias("links"))
    first = F.struct(F.concat("p_name", F.lit("-"), p).alias("key"), F.lit(None).cast("string").alias("filename"), F.struct(F.col("p_brand").alias("self"), F.lit(None).cast("string").alias("download")).alias("links"))
    return metadata.file_urls(t(spark, d, "part").select(F.to_json(F.struct(F.array(first, second).alias("files"))).alias("json")))


def checked_of(spark, d):
    k = F.col("s_suppkey")
    none = lambda x: F.lit(None).cast("string").alias(x)
    st = t(spark, d, "supplier").select(
        k.cast("string").alias("speaker_id"), (k % 50 + 1).alias("shard_size_bytes"), none("shard_sha256"), F.when(k % 2 == 0, "DONE").otherwise("QC").alias("status"), k.alias("seq"), F.when(k % 4 == 0, F.concat(F.lit("/s/"), k.cast("string"), F.lit(".tar"))).alias("shard_path"),
        F.concat(F.lit("/m/"), k.cast("string"), F.lit(".json")).alias("metadata_path"), F.when(k % 5 == 0, "e").alias("last_error"), F.lit("t").alias("completed_at"),
    )
    inv = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("speaker_id"), F.when(F.col("p_partkey") % 6 == 1, 0).otherwise(F.col("p_partkey") % 50 + 1).cast("bigint").alias("shard_size"), F.lit("x").alias("shard_sha"), (F.col("p_partkey") % 3 != 0).alias("has_metadata"))
    return state.verified(st, inv)


CHECKED = "c AS (SELECT s_suppkey AS k, p_partkey IS NOT NULL AND s_suppkey % 3 <> 0 AND s_suppkey % 6 <> 1 AS verified FROM supplier LEFT JOIN part ON p_partkey = s_suppkey)"


@query(f"WITH {CHECKED} SELECT k::VARCHAR AS speaker_id FROM c WHERE NOT verified")
def left_to_process(spark, d):
    return state.to_process(checked_of(spark, d)).select("speaker_id")


@query(f"WITH {CHECKED} SELECT k::VARCHAR AS speaker_id, k + 1 AS seq, 'reconcile' AS kind, 'DONE' AS status, 'now' AS ts, '/s/' || k || '.tar' AS shard_path, '/m/' || k || '.json' AS metadata_path FROM c WHERE verified AND NOT (k % 4 = 0 AND k % 5 <> 0)")
def reconciled(spark, d):
    return state.reconciled(checked_of(spark, d), "/s", "/m", "now").select("speaker_id", "seq", "kind", "status", "ts", "shard_path", "metadata_path")


@query("SELECT 's' || (c_custkey % 34 + 1) AS speaker_id, CASE WHEN NOT bool_or(c_custkey % 3 = 0 AND c_acctbal > 0) THEN 'there are no video files' ELSE 'there are no audio files' END AS error FROM customer GROUP BY 1 HAVING NOT bool_or(c_custkey % 3 = 0 AND c_acctbal > 0) OR NOT bool_or(c_custkey % 2 = 0 AND c_acctbal > 4000)")
def layout_faults(spark, d):
    c = t(spark, d, "customer").withColumn("speaker_id", F.concat(F.lit("s"), (F.col("c_custkey") % 34 + 1).cast("string")))
    return pairing.layout_faults(c.select("speaker_id").distinct(), c.where("c_custkey % 3 = 0 and c_acctbal > 0"), c.where("c_custkey % 2 = 0 and c_acctbal > 4000"))


@query(
    """WITH v AS (SELECT 's' || (o_custkey % 7 + 1) AS speaker_id, 'u' || (o_orderkey - o_orderkey % 10 // 9) AS utterance_id, max('/v/' || o_orderkey || '/U' || (o_orderkey - o_orderkey % 10 // 9) || '.mpg') AS video_path, count(*) AS nv FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2),
a AS (SELECT 's' || (o_custkey % 7 + 1) AS speaker_id, 'u' || (o_orderkey - o_orderkey % 10 // 9) AS utterance_id, max('/a/' || o_orderkey || '/u' || (o_orderkey - o_orderkey % 10 // 9) || '.wav') AS audio_path, count(*) AS na FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1, 2)
SELECT speaker_id, utterance_id, video_path, audio_path, CASE WHEN audio_path IS NULL THEN 'MISSING_AUDIO' WHEN video_path IS NULL THEN 'MISSING_VIDEO' WHEN na > 1 THEN 'DUPLICATE_AUDIO' WHEN nv > 1 THEN 'DUPLICATE_VIDEO' ELSE 'PAIRED' END AS pairing_status FROM v FULL JOIN a USING (speaker_id, utterance_id)"""
)
def pairing_strict(spark, d):
    o = t(spark, d, "orders").withColumn("speaker_id", F.concat(F.lit("s"), (F.col("o_custkey") % 7 + 1).cast("string")))
    path = lambda kind, u, ext: F.concat(F.lit(f"/{kind}/"), F.col("o_orderkey").cast("string"), F.lit(f"/{u}"), (F.col("o_orderkey") - F.floor(F.col("o_orderkey") % 10 / 9)).cast("string"), F.lit(ext)).alias("path")
    return pairing.pair(o.where("o_orderkey % 3 <> 0").select("speaker_id", path("v", "U", ".mpg")), o.where("o_orderkey % 4 <> 0").select("speaker_id", path("a", "u", ".wav")), strict=True)


# ---- quality, Gold, documents ----


@query(f"WITH {RECORDS} SELECT speaker_id, invalid_reason AS reason, count(*) AS n FROM q WHERE invalid_reason IS NOT NULL GROUP BY ALL")
def reason_counts(spark, d):
    return quality.reason_counts(records_of(spark, d))


@query("WITH w AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)), f AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 10 + l_linenumber <> 5) SELECT 's1' AS speaker_id, l_orderkey::VARCHAR AS utterance_id, bool_and(f.l_orderkey IS NOT NULL) AS readable FROM w LEFT JOIN f USING (l_orderkey, l_linenumber) WHERE r <= 3 GROUP BY w.l_orderkey, l_orderkey")
def spot_checks(spark, d):
    li = t(spark, d, "lineitem").select(F.lit("s1").alias("speaker_id"), F.col("l_orderkey").cast("string").alias("utterance_id"), F.col("l_linenumber").alias("frame_index"), "l_orderkey").distinct()
    frames = li.where("l_orderkey % 10 + frame_index <> 5").select("speaker_id", "utterance_id", "frame_index", F.lit(True).alias("readable"))
    return quality.spot_checked(frames, li.groupBy("speaker_id", "utterance_id").agg(F.collect_set("frame_index").alias("detected")), 3)


#: The published splits for seed 42 (fixed values); all other usable speakers are in train.
VAL, TEST = ("s30", "s34", "s9"), ("s25", "s2", "s8")


@query(
    f"""WITH u AS (SELECT 's' || i AS speaker_id, row_number() OVER (ORDER BY i) - 1 AS ordinal FROM range(1, 35) r(i) WHERE i <> 21),
x AS (SELECT *, CASE WHEN speaker_id IN {VAL} THEN 'val' WHEN speaker_id IN {TEST} THEN 'test' ELSE 'train' END AS split FROM u)
SELECT c_custkey, 's' || (c_custkey % 36 + 1) AS speaker_id, ordinal::INT AS ordinal, split, split IS NULL AS excluded FROM customer LEFT JOIN x ON x.speaker_id = 's' || (c_custkey % 36 + 1)"""
)
def split_dimension(spark, d):
    """Rows of excluded speakers, and of unknown ones, have no split."""
    c = t(spark, d, "customer").select("c_custkey", F.concat(F.lit("s"), (F.col("c_custkey") % 36 + 1).cast("string")).alias("speaker_id"))
    return c.join(F.broadcast(gold.split_dimension(spark, CorpusConfig())), "speaker_id", "left").select("c_custkey", "speaker_id", "ordinal", "split", F.col("split").isNull().alias("excluded"))


@query(f"WITH {GOLD_SQL}, s AS (SELECT unnest(['train', 'val', 'test']) AS split) SELECT s.split, count(g.split) AS utterances FROM s LEFT JOIN g ON g.split = s.split GROUP BY 1")
def gold_counts(spark, d):
    return spark.createDataFrame(list(gold.split_counts(gold_of(spark, d)).items()), "split string, utterances bigint")


@query(
    f"""WITH {RECORDS}, r AS (SELECT *, CASE WHEN lvl = 3 AND k % 12 > 0 THEN (k % 9)::DOUBLE / (k % 12) ELSE 0.0::DOUBLE END AS ratio FROM q)
SELECT speaker_id, count(*) AS total, count(*) FILTER (invalid_reason IS NULL) AS valid, count(*) AS n_samples, arg_min(utterance_id, utterance_id) AS first, round_even(arg_min(ratio, utterance_id), 4) AS first_ratio, '/shards/' || speaker_id || '.tar' AS path, 'DONE' AS status, '25.0' AS fps FROM r GROUP BY speaker_id"""
)
def speaker_documents(spark, d):
    """The documents' files, which many tasks write, read back by their lines: no row, task or group holds a speaker's samples."""
    records = records_of(spark, d)
    speakers = records.select("speaker_id").distinct()
    info = speakers.select("speaker_id", F.concat(F.lit("/shards/"), "speaker_id", F.lit(".tar")).alias("path"), F.lit(1).cast("bigint").alias("size"), F.lit("00").alias("sha256"))
    sources = speakers.select("speaker_id", F.lit("primary").alias("video_source_used"), F.lit("primary").alias("audio_source_used"))
    folder = f"{re.sub('^file:/*', '/', shared_folder(spark))}/corvane-{uuid.uuid4().hex}"
    get = lambda kind, path: F.max(F.when(F.col("kind") == kind, F.get_json_object("json", f"$.{path}")))
    first = lambda path: F.max(F.when(F.col("first"), F.get_json_object("json", f"$.{path}")))
    try:
        files.long_documents(*corpus.document_parts(records, info, sources, CorpusConfig(), clock=lambda: "now"), folder)
        read = metadata.lines(spark, folder).groupBy("speaker_id").agg(
            get("head", "summary.total_candidates").cast("bigint").alias("total"), get("head", "summary.valid_samples").cast("bigint").alias("valid"), F.count_if(F.col("kind") == "sample").alias("n_samples"), first("utterance_id").alias("first"),
            first("face_detection_ratio").cast("double").alias("first_ratio"), get("tail", "shard.path").alias("path"), get("head", "status").alias("status"), get("head", "processing.expected_fps").alias("fps"),
        )
        return settled(read)
    finally:
        shutil.rmtree(folder, ignore_errors=True)  # nobody needs the files later


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2")
def first_n(spark, d):
    return manifest.first(t(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], 2)
