"""Streams and archives as queries: a state log that grows while it is followed, and archives that are packed, indexed and read back.

Documents stand for events of the log, and for members of archives, by doc_id.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.numbering import shared_folder
from corvane.plans.catalogue import query, t
from corvane.schemas import EVENT
from corvane.sinks import shards
from corvane.sources import members
from corvane.streaming import state as stream

#: Speakers of the log, archives, the archive that is broken, and the longest member that is read.
SPEAKERS, ARCHIVES, BROKEN, LIMIT = 997, 64, 3, 4096
#: The log comes in so many pieces, and the stream is started anew for each.
PIECES = 3
#: Tasks that hold the streams' state, a small row a key.
TASKS = 16
EPOCH = 1704067200


def place(spark: SparkSession) -> str:
    return f"{re.sub('^file:/*', '/', shared_folder(spark))}/corvane-{uuid.uuid4().hex}"


EVENTS = f"""e AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL),
l AS (SELECT 's' || doc_id % {SPEAKERS} AS speaker_id, doc_id + 1 AS seq, {EPOCH} + doc_id * 60 AS sec, strftime(make_timestamp(({EPOCH} + doc_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts,
  CASE doc_id % 6 WHEN 0 THEN 'start' WHEN 1 THEN 'failure' WHEN 2 THEN 'done' ELSE 'transition' END AS kind, CASE doc_id % 6 WHEN 1 THEN 'FAILED' WHEN 2 THEN 'DONE' WHEN 3 THEN 'QC' WHEN 4 THEN 'PACKAGING' WHEN 5 THEN 'UPLOADING' END AS status,
  CASE WHEN doc_id % 6 = 1 THEN 'e' || doc_id % 10 END AS error, CASE WHEN doc_id % 6 = 2 THEN doc_id END AS shard_size_bytes FROM e)"""


def logged(docs: DataFrame) -> DataFrame:
    k = F.col("doc_id")
    m = k % 6
    at = F.to_utc_timestamp(F.timestamp_seconds(F.lit(EPOCH) + k * 60), F.current_timezone())
    given = {
        "speaker_id": F.concat(F.lit("s"), (k % SPEAKERS).cast("string")), "seq": k + 1, "ts": F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        "kind": F.when(m == 0, "start").when(m == 1, "failure").when(m == 2, "done").otherwise("transition"), "status": F.when(m == 1, "FAILED").when(m == 2, "DONE").when(m == 3, "QC").when(m == 4, "PACKAGING").when(m == 5, "UPLOADING"),
        "error": F.when(m == 1, F.concat(F.lit("e"), (k % 10).cast("string"))), "shard_size_bytes": F.when(m == 2, k),
    }
    return docs.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields))


def grown(spark: SparkSession, d: str, made, *keys: str) -> DataFrame:
    """The last rows of the stream made(events) after the log has come in pieces, in the order of doc_id, each followed by a run of the stream that goes on
    from the one before."""
    docs, folder = t(spark, d, "documents").select("doc_id").where("doc_id is not null"), place(spark)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    out = lambda: made(stream.events(spark, f"{folder}/log"))
    ends = [] if low is None else [low + (high - low) * i // PIECES for i in range(1, PIECES + 1)]
    for begin, end in zip([None, *ends], ends):
        piece = docs.where(F.col("doc_id") <= end) if begin is None else docs.where((F.col("doc_id") > begin) & (F.col("doc_id") <= end))
        logged(piece).write.mode("append").json(f"{folder}/log/commits")
        stream.followed(out(), folder, TASKS)
    return stream.shown(out(), folder, *keys)


@query(
    f"""WITH {EVENTS}, b AS (SELECT *, coalesce(max(CASE WHEN kind = 'start' THEN seq END) OVER (PARTITION BY speaker_id), -1) AS s0 FROM l)
SELECT speaker_id, coalesce(arg_max(status, seq) FILTER (status IS NOT NULL), 'PENDING') AS status, count(*) FILTER (kind = 'start') AS attempt_count, arg_min(ts, seq) FILTER (seq >= s0 AND (kind = 'start' OR status NOT IN ('PENDING', 'DONE'))) AS started_at,
arg_max(ts, seq) FILTER (kind = 'done' AND seq >= s0) AS completed_at, nullif(arg_max(coalesce(error, ''), seq) FILTER (kind IN ('start', 'done', 'failure')), '') AS last_error, arg_max(shard_size_bytes, seq) FILTER (shard_size_bytes IS NOT NULL) AS shard_size_bytes, max(seq) AS seq FROM b GROUP BY speaker_id"""
)
def state_followed(spark, d):
    """The state of each speaker, kept by the stream over restarts."""
    out = grown(spark, d, stream.latest, "speaker_id")
    return out.select("speaker_id", "status", "attempt_count", "started_at", "completed_at", "last_error", "shard_size_bytes", "seq")


@query(f"WITH {EVENTS} SELECT sec // 3600 * 3600 AS hour, count(*) AS failures FROM l WHERE kind = 'failure' GROUP BY 1")
def failures_followed(spark, d):
    """Failures an hour of event time, with windows that stay open over restarts until the watermark has passed them."""
    return grown(spark, d, stream.failures_by_hour, "hour").select(F.unix_timestamp(F.col("hour.start")).alias("hour"), "failures")


@query(
    f"""WITH x AS (SELECT doc_id, 's' || doc_id % {ARCHIVES} || '/' || doc_id || '/text.txt' AS name, coalesce(text, '') AS text, octet_length(encode(coalesce(text, '')))::BIGINT AS size FROM documents WHERE doc_id IS NOT NULL)
SELECT name, size, CASE WHEN size <= {LIMIT} THEN sha256(text) END AS sha256, CASE WHEN size > {LIMIT} THEN 'Oversized member ' || name || ': ' || size || ' bytes' END AS error FROM x WHERE doc_id % {ARCHIVES} <> {BROKEN}
UNION ALL SELECT DISTINCT 's{BROKEN}.tar', NULL::BIGINT, NULL, 'unreadable' FROM x WHERE doc_id % {ARCHIVES} = {BROKEN}"""
)
def archives_read(spark, d):
    """Texts packed as members of archives, these indexed by ranges of 4 MB and read back: what is too long, and an archive that breaks off in its first
    header, are rows with their error, and the others go on."""
    folder, k = place(spark), F.col("doc_id")
    docs = t(spark, d, "documents").where("doc_id is not null")
    shards.package(docs.select(F.concat(F.lit("s"), (k % ARCHIVES).cast("string")).alias("speaker_id"), k.cast("string").alias("utterance_id"), F.lit("text.txt").alias("filename"), F.coalesce("text", F.lit("")).cast("binary").alias("content")), folder)
    fs, base = shards.store(folder)
    if fs.get_file_info(f"{base}/s{BROKEN}.tar").size:
        with fs.open_output_stream(f"{base}/s{BROKEN}.tar") as f:
            f.write(b"s" * 100)
    rows = members.of_folder(spark, folder, range_bytes=4 << 20)
    bad = members.faults(rows).select(F.regexp_extract("archive", r"([^/]+)\z", 1).alias("name"), F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("sha256"), F.lit("unreadable").alias("error"))
    read = members.content(rows.where("name is not null"), max_member_bytes=LIMIT, strict=False)
    return read.select("name", "size", F.sha2("content", 256).alias("sha256"), "error").unionByName(bad)
