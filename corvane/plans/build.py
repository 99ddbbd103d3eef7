"""Building the corpus: from speakers' archives to shards, metadata, state and Gold.

Speakers go through the stages as sets: archives are read by the archive source, pairing, media, quality and packing are one plan over
all speakers, partitioned by utterance. What brings media with it (download, video reader, face detector, image encoder, audio
converter) is passed in. An error of one speaker is in its state and doesn't stop the others: archives that can't be had or read are rows with an
error, carried through the plan. Only if a run fails by something unforeseen does each speaker go on alone. The driver holds rows by
speaker only, of which the format has 33.
"""

from __future__ import annotations

import hashlib
import logging
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.config import CorpusConfig
from corvane.errors import CorvaneError, StoreUnavailableError
from corvane.functions.media import process_audio, process_videos
from corvane.operators import integrity, pairing, quality, state
from corvane.operators.numbering import settled
from corvane.plans import corpus
from corvane.sinks import files
from corvane.sources import archive, download, metadata
from corvane.sources import members as members_of

log = logging.getLogger("corvane.build")


@dataclass(frozen=True)
class Media:
    """What the builder needs and this package doesn't have. Archives come from sources(speaker), rows of (kind, source, url, format) with kind video or audio, in order
    of preference, which are fetched on executors through open_url to the corpus's bronze folder; or from acquire(speaker), which gives paths of the video and the audio
    archive and the names of their sources, and raises DownloadError or ArchiveError. opener opens an archive by its path. The others make, once a task: reader, detector, encoder and converter as
    functions.media describes, from files' bytes; the converter's new file is in WAV."""

    acquire: Callable | None
    reader: Callable
    detector: Callable
    encoder: Callable
    converter: Callable
    sources: Callable | None = None
    open_url: Callable | None = None
    opener: Callable = members_of.opened


def acquired(spark: SparkSession, c: CorpusConfig, speakers: list[str], media: Media) -> tuple[dict[str, tuple], dict[str, str]]:
    """Of each speaker the video and the audio archive and the names of their sources; and errors of those that lack one."""
    got: dict[str, tuple] = {}
    errors: dict[str, str] = {}
    if media.sources is None:
        for s in speakers:
            try:
                got[s] = media.acquire(s)
            except CorvaneError as e:
                errors[s] = str(e)
        return got, errors
    bronze = f"{os.path.abspath(c.root)}/bronze"
    place = lambda kind, url: f"{bronze}/{kind}/{hashlib.sha256(url.encode()).hexdigest()[:16]}-{url.rstrip('/').rsplit('/', 1)[-1]}"
    rows = [(s, kind, i, source, url, place(kind, url), format) for s in speakers for i, (kind, source, url, format) in enumerate(media.sources(s))]
    wanted = spark.createDataFrame(rows, "speaker_id string, kind string, priority int, source string, url string, dest string, format string")
    found = {(r["speaker_id"], r["kind"]): r for r in download.acquired(wanted, media.open_url, c).collect()}
    for s in speakers:
        mine = [found.get((s, kind)) for kind in ("video", "audio")]
        fault = next((f"no source for {kind}" if r is None else r["error"] for kind, r in zip(("video", "audio"), mine) if r is None or r["error"]), None)
        if fault:
            errors[s] = fault
        else:
            got[s] = (mine[0]["dest"], mine[1]["dest"], mine[0]["source"], mine[1]["source"])
    return got, errors


def archived(spark: SparkSession, got: dict[str, tuple], media: Media) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Video and audio files in the speakers' archives, as rows of an index with speaker_id and path; and speaker_id, error for archives that
    can't be read. An archive is indexed once, whoever has files in it; of one for several speakers each has what is in folders of their
    name, or all of it if there is none."""
    table = spark.createDataFrame([(s, kind, path) for s, x in got.items() for kind, path in zip(("video", "audio"), x)], "speaker_id string, kind string, archive string")
    index = members_of.index(table.select("archive").distinct(), opener=media.opener)
    faults = members_of.faults(index).join(table, "archive").groupBy("speaker_id").agg(F.min("error").alias("error"))
    suffix = F.when(F.col("kind") == "video", ".mpg").otherwise(".wav")
    each = index.where("error is null").drop("error").join(F.broadcast(table), "archive").where(F.lower("filename").endswith(suffix))
    each = each.withColumn("mine", F.array_contains(F.split("prefix", "/"), F.col("speaker_id")))
    shared = table.groupBy("kind", "archive").agg((F.count("*") > 1).alias("shared"))
    own = each.groupBy("kind", "speaker_id").agg(F.bool_or("mine").alias("own"))
    files_ = settled(each.join(shared, ["kind", "archive"]).join(own, ["kind", "speaker_id"]).where("not shared or mine or not own").withColumn("path", F.concat("prefix", "filename")).drop("shared", "own", "mine"))
    return files_.where("kind = 'video'"), files_.where("kind = 'audio'"), faults


def candidates(videos: DataFrame, audios: DataFrame, limit: int | None) -> DataFrame:
    """Pairs of files, unpaired ones included, unless there is a limit."""
    return pairing.limited(pairing.pair(videos.select("speaker_id", "path"), audios.select("speaker_id", "path"), check=False), limit)


def processed(pairs: DataFrame, videos: DataFrame, audios: DataFrame, media: Media, c: CorpusConfig) -> DataFrame:
    """Each pair with what its media gave: what quality.classify takes, and crops and converted."""
    paired = pairs.where("pairing_status = 'PAIRED'")
    of = lambda files, kind: paired.select("speaker_id", "utterance_id", F.col(f"{kind}_path").alias("path")).join(files, ["speaker_id", "path"])
    # a file that can't be read has no content, and its video or audio fails
    file = lambda files, kind: members_of.content(of(files, kind), c.max_member_bytes, False, media.opener)
    v = process_videos(file(videos, "video"), media.reader, media.detector, c.detector_batch, c.fps, c.fps_tolerance, media.encoder, "content")
    a = process_audio(file(audios, "audio"), media.converter, c.audio_rate, c.min_audio_sec, "content")
    raised = F.col("video_reason") == "VIDEO_DECODE_FAILED"
    v = v.withColumnRenamed("invalid_reason", "video_reason").select("*", raised.alias("video_failed"))
    a = a.withColumnsRenamed({"invalid_reason": "audio_reason", "success": "audio_success"}).withColumn("audio_failed", F.lit(False))
    out = pairs.join(v, ["speaker_id", "utterance_id"], "left").join(a, ["speaker_id", "utterance_id"], "left")
    return out.withColumns({"readable": F.lit(True), "has_audio": F.col("converted").isNotNull()})


def members(media_rows: DataFrame) -> DataFrame:
    """speaker_id, utterance_id, filename, content of what goes into shards: crops by their frames' indices, and the audio."""
    crop = media_rows.select("speaker_id", "utterance_id", F.explode("crops").alias("x")).select("speaker_id", "utterance_id", F.concat(F.col("x.frame_index").cast("string"), F.lit(".jpg")).alias("filename"), "x.content")
    audio = media_rows.where("converted is not null").select("speaker_id", "utterance_id", F.lit("audio.wav").alias("filename"), F.col("converted").alias("content"))
    return crop.unionByName(audio)


def process(spark: SparkSession, c: CorpusConfig, speakers: list[str], media: Media, record: state.Log, limit: int | None = None, dry_run: bool = False, clock: Callable[[], str] = corpus.now) -> None:
    """Take speakers through all stages; what becomes of them is in the log."""
    step = lambda names, status: record.add(*((s, "transition", {"status": status}) for s in names))
    record.add(*((s, kind, more) for s in speakers for kind, more in (("start", {}), ("transition", {"status": "DOWNLOADING"}))))
    if dry_run:
        step(speakers, "EXTRACTING")
        return
    got, errors = acquired(spark, c, speakers, media)
    for s, error in errors.items():
        fail(record, s, error)
    if not got:
        return
    step(got, "EXTRACTING")
    dimension = spark.createDataFrame([(s, *got[s][2:]) for s in got], "speaker_id string, video_source_used string, audio_source_used string")
    videos, audios, faults = archived(spark, got, media)
    broken = {r["speaker_id"]: r["error"] for r in faults.collect()}
    for r in pairing.layout_faults(dimension, videos, audios).collect():
        broken.setdefault(r["speaker_id"], r["error"])
    for s, error in broken.items():
        fail(record, s, error)
        got.pop(s)
    if not got:
        return
    step(got, "PREPROCESSING")
    mine = F.col("speaker_id").isin(list(got))
    # crops and audio are written once, so that no lost executor has videos decoded again
    rows = settled(processed(candidates(videos.where(mine), audios.where(mine), limit), videos, audios, media, c))
    records = settled(quality.classify(rows, c))
    step(got, "QC")
    for r in quality.reason_counts(records).collect():
        log.info("[%s] %s: %d", r["speaker_id"], r["reason"], r["n"])
    good = {r["speaker_id"] for r in records.where("valid").select("speaker_id").distinct().collect()}
    for s in [s for s in got if s not in good]:
        fail(record, s, "no valid utterances after the checks")
        got.pop(s)
    if not got:
        return
    step(got, "PACKAGING")
    valid = records.where("valid").select("speaker_id", "utterance_id")
    info = corpus.pack(spark, members(rows), valid, c.shards)
    step(got, "UPLOADING")
    # what lies in the store is read back
    for r in integrity.shard_problems(info, archive.digests(info)).join(info.select("speaker_id", "path"), "path").collect():
        fail(record, r["speaker_id"], f"its shard in the store: {r['problem']}")
        got.pop(r["speaker_id"], None)
    ends, items = corpus.document_parts(records.where(F.col("speaker_id").isin(list(got))), info, dimension, c, clock)
    paths = files.long_documents(ends, items.join(F.broadcast(ends.select("speaker_id")), "speaker_id", "left_semi"), c.metadata)
    done = {r["speaker_id"]: r for r in info.collect()}
    record.add(*((s, "done", {"shard_path": done[s]["path"], "metadata_path": paths[s], "shard_size_bytes": done[s]["size"], "shard_sha256": done[s]["sha256"], "video_source_used": got[s][2], "audio_source_used": got[s][3]}) for s in got))


def fail(record: state.Log, speaker: str, error: str) -> None:
    log.error("[%s] %s", speaker, error)
    record.add((speaker, "failure", {"error": error}))


def build(spark: SparkSession, c: CorpusConfig, speakers: list[str], media: Media, force: bool = False, limit: int | None = None, dry_run: bool = False, clock: Callable[[], str] = corpus.now) -> DataFrame:
    """Process speakers whose artefacts don't verify (all with force), and build Gold if all usable ones were asked for and are done. The
    states after that. Speakers go together; if that fails, one by one, and an unexpected error is that speaker's failure."""
    record = state.Log(spark, f"{c.state}/log", clock)
    catalogue = spark.createDataFrame([(s,) for s in c.usable()], "speaker_id string")
    adopt(metadata.state_file(spark, f"{c.state}/processing_state.json", catalogue), record)
    todo = list(speakers)
    if not force:
        for folder in (c.shards, c.metadata):
            files.make_folder(folder)
        open_, known = corpus.resume(spark, c, record.events(), clock=clock)
        asked = F.col("speaker_id").isin(todo)
        record.extend(known.where(asked))
        waiting = {r["speaker_id"]: r["status"] for r in open_.where(asked).select("speaker_id", "status").collect()}
        for s in [s for s in todo if s not in waiting]:
            log.info("[%s] shard and metadata are there and verified", s)
        for s in [s for s, status in waiting.items() if status == "DONE"]:
            log.warning("[%s] is done by its state, but its shard or metadata isn't as recorded", s)
        todo = [s for s in todo if s in waiting]
    try:
        process(spark, c, todo, media, record, limit, dry_run, clock) if todo else None
    except Exception as e:
        log.warning("a run over %d speakers failed (%s: %s); each goes on alone", len(todo), type(e).__name__, str(e)[:200])
        done = {r["speaker_id"] for r in state.state(catalogue, record.events()).where("status in ('DONE', 'FAILED')").collect()}
        for s in [s for s in todo if s not in done or len(todo) == 1]:
            try:
                process(spark, c, [s], media, record, limit, dry_run, clock)
            except Exception as own:
                fail(record, s, f"unexpected: {type(own).__name__}: {str(own)[:500]}")
    states = state.state(catalogue, record.events())
    if set(speakers) >= set(c.usable()) and not dry_run:
        if not corpus.gold_when_done(spark, c, states):
            waiting = [r["speaker_id"] for r in states.where("status <> 'DONE'").limit(10).collect()]
            log.info("Gold isn't built: not done are %s", ", ".join(waiting))
    return states


def adopt(states: DataFrame, record: state.Log) -> None:
    """Begin a new log with what a state document of before has of its speakers, a row each."""
    if record.seq:
        return
    events: list[tuple] = []
    for r in states.where("status <> 'PENDING'").orderBy("speaker_id").collect():
        more = {f: r[f] for f in state.FIELDS if r[f] is not None}
        events += [(r["speaker_id"], "start", {"ts": r["started_at"]})] * max(1, r["attempt_count"])
        if r["status"] == "FAILED":
            events.append((r["speaker_id"], "failure", more | {"error": r["last_error"], "ts": r["completed_at"]}))
        elif r["status"] == "DONE":
            events.append((r["speaker_id"], "done", more | {"ts": r["completed_at"]}))
        else:
            events.append((r["speaker_id"], "transition", more | {"status": r["status"]}))
    record.add(*events)


def check_store(c: CorpusConfig) -> None:
    """Raise unless the root can be written."""
    try:
        files.write_atomically(f"{c.root}/.corvane-check", b"")
    except CorvaneError as e:
        raise StoreUnavailableError(f"{c.root} can't be written: {e}") from e
    files.remove(f"{c.root}/.corvane-check")


def available(spark: SparkSession, c: CorpusConfig) -> DataFrame:
    """Shards and metadata that are there, as metadata.inventory gives them, without digests."""
    return metadata.inventory(spark, c.shards, c.metadata, digests=False)
