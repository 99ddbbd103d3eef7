"""Profiles of files and tables: never more than a few rows of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: what a profile shows of a manifest, of a JSON document, and of its first sample ----
SAFE = ("split", "speaker_id", "utterance_id", "frame_count", "first_frame_index", "last_frame_index", "audio_sample_rate", "valid")
FIRST = ("utterance_id", "valid", "frame_count", "cropped_frame_count", "face_detection_ratio", "audio_sample_rate", "audio_duration_sec", "shard_member_prefix")
SCALARS = ("schema_version", "status", "speaker_id", "strategy", "seed", "partial")
OBJECTS = ("summary", "shard", "utterance_counts", "invalid_reason_counts")
LISTS = ("train_speakers", "val_speakers", "test_speakers", "missing_speakers")


def preview(entries: DataFrame, n: int = 12) -> DataFrame:
    """The first n of entries(name, is_dir): folders first, then by name in any case."""
    return entries.orderBy(F.col("is_dir").desc(), F.lower("name")).limit(n)


def entry_counts(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count_if("is_dir").alias("dirs"), F.count_if(~F.col("is_dir")).alias("files"))


def shard_totals(files: DataFrame) -> DataFrame:
    """Number and total size of .tar files(path, size)."""
    return files.where(F.col("path").endswith(".tar")).agg(F.count("*").alias("shards"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def shard_inventory(files: DataFrame, n: int = 40) -> DataFrame:
    """name, size of the first n .tar files(path, size) by name; nothing is opened."""
    return files.where(F.col("path").endswith(".tar")).select(F.regexp_extract("path", r"([^/]+)\z", 1).alias("name"), "size").orderBy(F.lower("name"), "name").limit(n)


def json_objects(docs: DataFrame) -> DataFrame:
    """path, key, keys, numbers of docs(path, json): for each object that a profile shows its sorted keys and, as text, its fields that are
    numbers or truth values."""
    inner = F.expr("get_json_object(json, concat('$.', key))")
    rows = docs.select("path", "json", F.explode(F.array(*map(F.lit, OBJECTS))).alias("key")).select("path", "key", inner.alias("o"))
    fields = F.map_filter(F.from_json("o", "map<string,string>"), lambda k, v: v.rlike(r"^(-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?|true|false)\z"))
    return rows.where(F.json_object_keys("o").isNotNull()).select("path", "key", F.array_sort(F.json_object_keys("o")).alias("keys"), fields.alias("numbers"))


def json_speakers(docs: DataFrame, n: int = 40) -> DataFrame:
    """path, key, count, ids of docs(path, json): for each list of speakers its length and, if all are speakers' ids, the first n."""
    rows = docs.select("path", "json", F.explode(F.array(*map(F.lit, LISTS))).alias("key")).select("path", "key", F.from_json(F.expr("get_json_object(json, concat('$.', key))"), "array<string>").alias("ids"))
    safe = F.forall("ids", lambda x: x.rlike(r"^s[0-9]+\z"))
    return rows.where("ids is not null").select("path", "key", F.size("ids").alias("count"), F.when(safe, F.slice("ids", 1, n)).alias("ids"))


def json_statuses(docs: DataFrame) -> DataFrame:
    """path, status, n of the speakers in docs(path, json) that are state documents."""
    s = docs.select("path", F.explode(F.map_values(F.from_json(F.get_json_object("json", "$.speakers"), "map<string,struct<status:string>>"))).alias("s"))
    return s.groupBy("path", F.coalesce("s.status", F.lit("UNKNOWN")).alias("status")).agg(F.count("*").alias("n"))


def status_histogram(states: DataFrame, column: str = "status") -> DataFrame:
    return states.groupBy(F.coalesce(F.col(column), F.lit("UNKNOWN")).alias("status")).agg(F.count("*").alias("n"))


def json_profile(docs: DataFrame) -> DataFrame:
    """Of docs(path, json): sorted root keys, some scalars, number of samples, keys of the first sample and, of some of them, its plain values."""
    v = F.try_parse_json("json")
    first = F.get_json_object("json", "$.samples[0]")
    size = F.json_array_length(F.get_json_object("json", "$.samples"))
    # objects and lists aren't plain values; nulls are no values
    shown = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, FIRST)), F.array(*[F.get_json_object(first, f"$.{k}") for k in FIRST])), lambda k, x: x.isNotNull() & ~x.rlike(r"^\s*[\[{]"))
    return docs.select("path", v.isNotNull().alias("readable"), F.array_sort(F.json_object_keys("json")).alias("root_keys"), *[F.get_json_object("json", f"$.{k}").alias(k) for k in SCALARS], size.alias("samples"), F.array_sort(F.json_object_keys(first)).alias("sample_keys"), shown.alias("sample_fields"))


def csv_profile(df: DataFrame, n: int = 2) -> tuple[list[str], DataFrame]:
    """The header and the first n rows of columns that name no paths; the file isn't counted."""
    return df.columns, df.select(*[c for c in SAFE if c in df.columns]).limit(n)
