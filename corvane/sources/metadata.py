"""Speakers' metadata, state files and file listings as sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.errors import DownloadError
from corvane.schemas import METADATA
from corvane.sources import archive


def speakers(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each readable <speaker>.json; files that can't be parsed are left out. speaker_id is the file's name."""
    return _documents(spark, folder).where(READABLE).drop("_corrupt")


def unreadable(spark: SparkSession, folder: str) -> list[str]:
    """The speakers whose files speakers() leaves out; a file a speaker."""
    return sorted(r["speaker_id"] for r in _documents(spark, folder).where(f"not ({READABLE})").select("speaker_id").collect())


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """speaker_id, kind (head, sample, tail), first (of its samples), json for the lines of documents as sinks.files.long_documents writes them. So files of
    any length are read in blocks. A head's json has no samples."""
    df = spark.read.text(f"{folder}/*.json").select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json\z", 1).alias("speaker_id"), "value")
    kind = F.when(F.col("value").endswith('"samples":['), "head").when(F.col("value").startswith("]"), "tail").otherwise("sample")
    text = F.when(F.col("kind") == "head", F.concat("value", F.lit("]}"))).when(F.col("kind") == "tail", F.concat(F.lit("{"), F.substring("value", F.lit(3), F.length("value")))).otherwise(F.ltrim("value", F.lit(",")))
    return df.withColumn("kind", kind).select("speaker_id", "kind", ((F.col("kind") == "sample") & ~F.col("value").startswith(",")).alias("first"), text.alias("json"))


READABLE = "_corrupt is null and (status is not null or samples is not null)"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.read.schema(T.StructType([*METADATA.fields, T.StructField("_corrupt", T.StringType())])).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(f"{folder}/*.json")
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json\z", 1)
    return df.withColumn("speaker_id", name)


def state_file(spark: SparkSession, path: str, catalogue: DataFrame) -> DataFrame:
    """Speakers' rows of a state document {speakers: {id: {...}}}; a missing or broken file gives PENDING rows only."""
    fields = "status STRING, attempt_count INT, started_at STRING, completed_at STRING, last_error STRING, video_source_used STRING, audio_source_used STRING, shard_path STRING, metadata_path STRING, shard_size_bytes BIGINT, shard_sha256 STRING"
    text = open(path, encoding="utf-8").read() if os.path.isfile(path) else None
    doc = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", f"speakers MAP<STRING, STRUCT<{fields.replace(' ', ': ').replace(',: ', ', ')}>>").alias("d"))
    rows = doc.select(F.explode("d.speakers").alias("speaker_id", "s")).select("speaker_id", "s.*")
    out = catalogue.select("speaker_id").join(rows, "speaker_id", "left")
    return out.withColumns({"status": F.coalesce("status", F.lit("PENDING")), "attempt_count": F.coalesce("attempt_count", F.lit(0))})


def files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """speaker_id (the first folder below), path, size of files by glob, at any depth; their bytes aren't read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", F.col("length").alias("size"))
    below = F.regexp_extract("path", r"/(s[0-9]+)/", 1)
    return df.select(below.alias("speaker_id"), "path", "size")


def inventory(spark: SparkSession, shards: str, metadata: str, digests: bool = True) -> DataFrame:
    """speaker_id, shard_size, shard_sha, has_metadata from the configured folders. Shards are listed, and read in chunks for their digests."""
    name = F.regexp_extract("path", r"([^/]+)\.[a-z]+\z", 1)
    tar = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(shards).select("path", F.col("length").alias("size"))
    found = archive.digests(tar.repartition("path")) if digests else tar.withColumn("sha256", F.lit(None).cast("string"))
    s = found.select(name.alias("speaker_id"), F.col("size").alias("shard_size"), F.col("sha256").alias("shard_sha"))
    m = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(metadata).select(name.alias("speaker_id"), F.lit(True).alias("has_metadata"))
    return s.join(m, "speaker_id", "full_outer")


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """name, is_dir, size of a local folder's entries."""
    rows = [(e.name, e.is_dir(), None if e.is_dir() else e.stat().st_size) for e in os.scandir(folder)] if os.path.isdir(folder) else []
    return spark.createDataFrame(rows, "name string, is_dir boolean, size bigint")


def documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path (the file's name), json of small JSON files, read whole on the driver; a byte order mark is dropped."""
    rows = [(os.path.basename(p), open(p, encoding="utf-8-sig", errors="replace").read()) for p in paths if os.path.isfile(p)]
    return spark.createDataFrame(rows, "path string, json string")


def file_urls(records: DataFrame) -> DataFrame:
    """filename, url from records(json) of an archive's listing: files, each with key or filename, and links self or download."""
    schema = "files ARRAY<STRUCT<key: STRING, filename: STRING, links: STRUCT<self: STRING, download: STRING>>>"
    f = records.select(F.explode(F.from_json("json", schema)["files"]).alias("f"))
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return f.select(F.coalesce(blank("f.key"), blank("f.filename")).alias("filename"), F.coalesce(blank("f.links.self"), blank("f.links.download")).alias("url")).where("filename is not null and url is not null")


def urls(records: DataFrame) -> dict[str, str]:
    """file_urls of one listing as a mapping; an empty listing is an error."""
    found = {r["filename"]: r["url"] for r in file_urls(records).collect()}
    if not found:
        raise DownloadError("the listing names no files")
    return found


def chosen_sources(catalogue: DataFrame, available: DataFrame) -> DataFrame:
    """For each speaker and kind (video, audio), independently: the primary source if its file is there and verified, else the fallback.
    available(speaker_id, kind, source, url, verified); speaker_id null stands for all speakers."""
    ok = available.where("verified")
    kinds = catalogue.select("speaker_id", F.explode(F.array(F.lit("video"), F.lit("audio"))).alias("kind"))
    pick = lambda s: ok.where(F.col("source") == s).select("speaker_id", "kind", F.col("url").alias(s))
    own = kinds.join(pick("primary"), ["speaker_id", "kind"], "left").join(pick("fallback"), ["speaker_id", "kind"], "left")
    shared = pick("fallback").where("speaker_id is null").select("kind", F.col("fallback").alias("shared"))
    out = own.join(shared, "kind", "left")
    url = F.coalesce("primary", "fallback", "shared")
    return out.select("speaker_id", "kind", F.when(F.col("primary").isNotNull(), "primary").when(url.isNotNull(), "zenodo_fallback").alias("source"), url.alias("url"))
