"""Integrity of archives and shards."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_digests(files: DataFrame) -> DataFrame:
    """files(path, content) with size and sha256, computed where the bytes are."""
    return files.withColumns({"size": F.octet_length("content").cast("bigint"), "sha256": F.sha2("content", 256)})


def missing_from_shards(valid: DataFrame, members: DataFrame) -> DataFrame:
    """Utterances(speaker_id, utterance_id) without any member in their shard: an equi-join on the folder, not a scan of prefixes."""
    prefix = F.concat("speaker_id", F.lit("/"), "utterance_id", F.lit("/"))
    return valid.withColumn("prefix", prefix).join(members.select("speaker_id", "prefix").distinct(), ["speaker_id", "prefix"], "left_anti").drop("prefix")


def shard_problems(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """expected(path, size, sha256) that actual(path, size, sha256) doesn't have alike, with what is wrong."""
    a = actual.select("path", F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    problem = F.when(F.col("_size").isNull(), "missing").when(F.col("_size") != F.col("size"), "size differs").when(F.col("_sha") != F.col("sha256"), "digest differs")
    return expected.join(a, "path", "left").select("path", problem.alias("problem")).where("problem is not null")


def zip_fault(data: bytes | str) -> str | None:
    """What is wrong with a zip archive, given by its bytes or its path; members are tested one by one."""
    try:
        with zipfile.ZipFile(data if isinstance(data, str) else io.BytesIO(data)) as z:
            bad = z.testzip()
            return f"bad member: {bad}" if bad else None
    except (zipfile.BadZipFile, EOFError, OSError) as e:
        return f"not a zip archive: {e}"


def tar_fault(data: bytes | str) -> str | None:
    """What is wrong with a tar archive, given by its bytes or its path; it is read from header to header."""
    try:
        with tarfile.open(data) if isinstance(data, str) else tarfile.open(fileobj=io.BytesIO(data)) as t:
            return None if sum(1 for _ in t) else "the archive is empty"
    except (tarfile.TarError, EOFError, OSError) as e:
        return f"not a tar archive: {e}"


@F.pandas_udf(T.StringType())
def archive_fault(kind: pd.Series, content: pd.Series) -> pd.Series:
    """What is wrong with an archive of kind zip or tar, given by its bytes or by its path, or null."""
    return pd.Series([{"zip": zip_fault, "tar": tar_fault}[k](c if isinstance(c, str) else bytes(c)) if k in ("zip", "tar") else "unknown kind of archive" for k, c in zip(kind, content)], dtype="object")
