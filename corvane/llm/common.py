"""Helpers that the operators of this folder share: folders, word hashes, Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Mixing constants of the 64-bit hashes; any fixed odd numbers would do.
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: Words that a worker keeps the hashes of; then it starts anew.
CACHE = 300_000
#: Folders named in the block of `passing` that this thread is in.
PASSING: ContextVar[list[str] | None] = ContextVar("PASSING", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset and all is on one machine (tests), an own one. On a
    cluster a folder of one machine would lose data, so there it must be set."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="corvane-")
        sc.setCheckpointDir(folder)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, kind: str) -> str:
    """A name, not yet used, in the shared folder. Who called within `passing` decides when it goes; else it stays until its owner deletes it."""
    folder = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    mine = PASSING.get()
    if mine is not None:
        mine.append(folder)
    return folder


@contextmanager
def passing() -> Iterator[list[str]]:
    """The folders that this thread's new_folder names within the block; they are deleted at its end, those taken out of the list excepted. For a run
    that has then written its result: what other runs have made, and lazy results of before still read, isn't touched."""
    folders: list[str] = []
    token = PASSING.set(folders)
    try:
        yield folders
    finally:
        PASSING.reset(token)
        for folder in folders:
            delete(folder)


def delete(folder: str) -> None:
    fs, path = filesystem(folder)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Whatever store the cluster's shared folder is in."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut: written to the shared folder and read from there, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the driver notice that finished steps are no longer referred to, so that Spark deletes their shuffle files now, not at some time.
    The first round drops Python's handles, the second finds what they held."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, n: int, key: str, kind: str) -> DataFrame:
    """df, already dealt by key into n partitions, as a table in the shared folder that is bucketed by key: joins and groupings on key find it
    dealt and don't shuffle it again."""
    spark, name = df.sparkSession, f"corvane_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").option("path", new_folder(spark, kind)).bucketBy(n, key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the catalogue's entry; the files are in a folder of their own and out knows how they are dealt
    return out


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what is run within."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def named(column: str) -> Column:
    """The column of that name, whatever is in the name."""
    return F.col("`" + column.replace("`", "``") + "`")


def free(prefix: str, df: DataFrame) -> str:
    """A prefix that no column of df begins with."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    return prefix


def filtered(df: DataFrame, column: str, stays: Callable[[bytes | None], bool]) -> DataFrame:
    """The rows of df for whose text in `column` stays is true, with all their columns, whatever these are called; one pass in Arrow batches."""
    at = df.columns.index(column)
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([stays(x) for x in batch.column(at).cast(pa.binary()).to_pylist()], pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


class WordHash(dict):
    """word (bytes) -> 64-bit hash; look-ups of words already seen stay in C."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finish of 64-bit sums: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(32))) * C2
    h = (h ^ (h >> np.uint64(29))) * C1
    return h ^ (h >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of the words hashed in h, in order; of all words as one if they are fewer than k; none without words."""
    n = len(h)
    if not n:
        return h
    kk = min(k, n)
    out = np.full(n - kk + 1, kk, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(kk):
            out = (out + h[j : n - kk + 1 + j]) * C1
            out ^= out >> np.uint64(31)
        return mixed(out)


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[dict | pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow with a function of one batch that yields dicts of columns."""
    fields = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in f(batch):
                yield pa.RecordBatch.from_arrays([out[x] if isinstance(out[x], pa.Array) else pa.array(out[x]) for x in fields], names=fields)

    return df.mapInArrow(run, schema)


def vector_total(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of vectors of `size` 64-bit integers, one a row of parts(v binary): treeReduce merges them on executors, so the driver adds up a
    few, however many tasks there were."""
    zero = np.zeros(size, np.int64)
    sums = parts.rdd.mapPartitions(lambda rows: [sum((np.frombuffer(r[0], np.int64) for r in rows), zero)])
    return sums.treeReduce(np.add, 3) if sums.getNumPartitions() else zero
