"""Shards: members packed into one uncompressed tar a speaker, on executors.

Members are ranged by speaker, utterance and file name, so a large speaker is spread over many tasks. Each task writes the records of
its range, headers included, as a part of each speaker in it (a Spark data source writer: parts are under a name of the write's own; its
commit lists them in a manifest, its abort deletes them). Records have a length that is known from the name and the size, so where each part
belongs in its tar is a prefix sum of the parts' bytes. Parts are compressed, since headers and padding are mostly zeros, so what is there twice while
a shard is assembled is small. The parts of a speaker are then streamed in that order into the shard, under a name of its own attempt, compared in size, and renamed; no member is held beyond its own record. Times and owners are left at zero, so the same
members give the same bytes, however many tasks wrote them. Files go through pyarrow, to whatever store the folder is in.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import tarfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from corvane.errors import ShardError
from corvane.operators.numbering import kept, settled, shared_folder

#: Fixed values of the format: a block, two empty ones at the end, and what a tar's length is a multiple of.
BLOCK, END, RECORD = 512, 1024, 10240
#: Where a header has its checksum.
CHECKSUM = slice(148, 156)
#: Bytes of records that are made together.
TOGETHER = 4 << 20
#: How parts are compressed; their bytes are counted without.
PACKING = "zstd"
ROW = T.StructType([T.StructField("speaker_id", T.StringType()), T.StructField("utterance_id", T.StringType()), T.StructField("filename", T.StringType()), T.StructField("content", T.BinaryType())])


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return pafs.LocalFileSystem(), os.path.abspath(uri)


def head(name: str, size: int) -> bytes:
    """A member's header, in as many blocks as its name needs."""
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.PAX_FORMAT, "utf-8", "surrogateescape")


def records(names: list[str], contents: list) -> Iterator[bytearray]:
    """The members' records, several together. Plain names of up to 100 characters differ in few of a header's bytes, so that their headers are made at once;
    others one by one. Beside the contents no more than TOGETHER bytes are held, or one record."""
    begin = 0
    while begin < len(names):
        end, held = begin, 0
        while end < len(names) and (end == begin or held + len(contents[end]) <= TOGETHER):
            held, end = held + len(contents[end]) + 2 * BLOCK, end + 1
        yield from _records(names[begin:end], contents[begin:end])
        begin = end


def _records(names: list[str], contents: list) -> Iterator[bytearray]:
    sizes = [len(c) for c in contents]
    if not all(n.isascii() and len(n) <= 100 for n in names) or max(sizes) >= 8**11:
        for name, data in zip(names, contents):
            yield bytearray(head(name, len(data)) + data + bytes(-len(data) % BLOCK))
        return
    heads = np.tile(np.frombuffer(head("", 0), np.uint8), (len(names), 1))
    heads[:, :100] = np.array([n.encode() for n in names], "S100").view(np.uint8).reshape(-1, 100)
    size = np.array(sizes, np.int64)
    for i in range(11):
        heads[:, 124 + i] = 48 + (size >> 3 * (10 - i) & 7)
    heads[:, CHECKSUM] = 32
    total = heads.sum(axis=1, dtype=np.int64)
    for i in range(6):
        heads[:, CHECKSUM.start + i] = 48 + (total >> 3 * (5 - i) & 7)
    heads[:, CHECKSUM.start + 6] = 0
    blocks = 1 + -(-size // BLOCK)
    at = np.concatenate([[0], np.cumsum(blocks)])
    out = bytearray(int(at[-1]) * BLOCK)
    np.frombuffer(out, np.uint8).reshape(-1, BLOCK)[at[:-1]] = heads
    for i, data in zip((at[:-1] * BLOCK + BLOCK).tolist(), contents):
        out[i : i + len(data)] = data
    yield out


@dataclass
class Parts(WriterCommitMessage):
    """What a task has written: speaker, path, bytes, members of each part, in the order of its range."""

    number: int = 0
    parts: list[tuple] = field(default_factory=list)


class PartWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Parts:
        fs, base = store(self.folder)
        number = TaskContext.get().partitionId()
        out, parts, stream = Parts(number), [], None
        tag = uuid.uuid4().hex
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:3]]
            contents = [b"" if c is None else c for c in batch.columns[3].to_pylist()]
            names = [f"{s}/{u}/{name}" for s, u, name in zip(*columns)]
            i = 0
            for s, mine in itertools.groupby(columns[0]):
                n = len(list(mine))
                if stream is None or s != parts[-1][0]:
                    if stream is not None:
                        stream.close()
                    path = f"{base}/{s}.{number:06d}.{tag}"
                    stream = fs.open_output_stream(path, compression=PACKING)
                    parts.append([s, path, 0, 0])
                for record in records(names[i : i + n], contents[i : i + n]):
                    stream.write(record)
                    parts[-1][2] += len(record)
                parts[-1][3] += n
                i += n
        if stream is not None:
            stream.close()
        out.parts = [tuple(p) for p in parts]
        return out

    def commit(self, messages: list[Parts | None]) -> None:
        """The manifest: without it nothing is there."""
        fs, base = store(self.folder)
        rows = [dict(zip(("speaker_id", "path", "bytes", "members"), p), number=m.number) for m in messages if m for p in m.parts]
        with fs.open_output_stream(f"{base}/parts.json") as f:
            f.write(json.dumps(rows).encode())

    def abort(self, messages: list[Parts | None]) -> None:
        """Nothing stays, of tasks that didn't end either: the folder is this write's own."""
        fs, base = store(self.folder)
        if fs.get_file_info(base).type == pafs.FileType.Directory:
            fs.delete_dir(base)


class ShardParts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corvane_shard_parts"

    def writer(self, schema: T.StructType, overwrite: bool) -> PartWriter:
        if schema.fieldNames() != ROW.fieldNames():
            raise ShardError(f"members have the columns {', '.join(ROW.fieldNames())}")
        return PartWriter(self.options)


def package(members: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """Write members(speaker_id, utterance_id, filename, content) to folder/<speaker>.tar, with at most `tasks` tasks (the session's shuffle partitions,
    unless given); returns speaker_id, path, size, sha256, members. Within a shard utterances are sorted by id and files by name as text. Speakers of that name are replaced, others
    stay."""
    spark = members.sparkSession
    fs, base = store(folder)
    fs.create_dir(base, recursive=True)
    parts = f"{base}/_parts-{uuid.uuid4().hex}"
    fs.create_dir(parts)
    # the store's own scheme, if it has one, for the tasks
    place = f"{folder.rstrip('/')}/{parts.rsplit('/', 1)[1]}" if "://" in folder or folder.startswith("file:") else parts
    spark.dataSource.register(ShardParts)
    keys = ["speaker_id", "utterance_id", "filename"]
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select(*keys, "content").repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    try:
        dealt.write.format("corvane_shard_parts").mode("append").save(place)
        with fs.open_input_stream(f"{parts}/parts.json") as f:
            listed = json.loads(f.read())
        return settled(assembled(spark, listed, folder))
    finally:
        if fs.get_file_info(parts).type == pafs.FileType.Directory:
            fs.delete_dir(parts)


def places(parts: DataFrame) -> DataFrame:
    """parts(speaker_id, number, path, bytes, members) with offset: where each begins in its speaker's tar, by a sum over the parts before."""
    before = Window.partitionBy("speaker_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("offset", F.coalesce(F.sum("bytes").over(before), F.lit(0)))


def assembled(spark: SparkSession, listed: list[dict], folder: str) -> DataFrame:
    """The shards from their parts, a task a speaker, in streams: a chunk is written and digested while the next is read."""
    schema = "speaker_id string, path string, bytes bigint, members bigint, number int"
    parts = places(spark.createDataFrame([(r["speaker_id"], r["path"], r["bytes"], r["members"], r["number"]) for r in listed], schema))

    def run(mine: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("offset")
        fs, base = store(folder)
        speaker = mine["speaker_id"].iloc[0]
        path = f"{base}/{speaker}.tar"
        attempt = f"{path}.{uuid.uuid4().hex}"
        sha, size = hashlib.sha256(), 0
        total = int(mine["bytes"].sum())
        with fs.open_output_stream(attempt) as out, ThreadPoolExecutor(2) as pool:
            busy = []

            def put(data: bytes) -> None:
                nonlocal size
                settle()
                busy.extend((pool.submit(out.write, data), pool.submit(sha.update, data)))
                size += len(data)

            def settle() -> None:
                for x in busy:
                    x.result()
                busy.clear()

            for part, offset in zip(mine["path"], mine["offset"]):
                if size != offset:
                    raise ShardError(f"{part} belongs at {offset}, not at {size}")
                with fs.open_input_stream(part, compression=PACKING) as f:
                    while chunk := f.read(1 << 20):
                        put(chunk)
            if size != total:
                raise ShardError(f"{speaker}: the parts have {size} of {total} bytes")
            put(bytes(END + -(total + END) % RECORD))
            settle()
        if fs.get_file_info(attempt).size != size:
            fs.delete_file(attempt)
            raise ShardError(f"{path}: the file's size differs from what was written")
        fs.move(attempt, path)
        return pd.DataFrame([(speaker, path, size, sha.hexdigest(), int(mine["members"].sum()))], columns=["speaker_id", "path", "size", "sha256", "members"])

    # not left to the session, which puts so few rows into one task, and all shards after one another; by ranges, as hashes of few speakers meet
    n = len({r["speaker_id"] for r in listed})
    return parts.repartitionByRange(max(1, min(4 * n, 20_000)), "speaker_id").groupBy("speaker_id").applyInPandas(run, "speaker_id string, path string, size bigint, sha256 string, members bigint")


def waves(members: DataFrame, held: int) -> list[list]:
    """The speakers of members(speaker_id, content), a few at a time: together of about `held` bytes as shards, or one that has more alone. The driver
    gets a row for each speaker."""
    size = BLOCK + F.ceil(F.coalesce(F.octet_length("content"), F.lit(0)) / BLOCK) * BLOCK
    out, total = [[]], 0
    for s, n in members.groupBy("speaker_id").agg(F.sum(size)).orderBy("speaker_id").collect():
        if out[-1] and total + n > held:
            out.append([])
            total = 0
        out[-1].append(s)
        total += n
    return out


def passed(members: DataFrame, use: Callable[[DataFrame, str], DataFrame], held: int = 4 << 30) -> DataFrame:
    """What use(package()'s rows, the shards' folder) gives of shards that nobody needs afterwards. They are made in waves of about `held` bytes, or
    of one speaker, and deleted when the wave's rows are written, so that the shards of one wave are there at a time. use() must go by speaker; it
    may write to the folder above the shards'."""
    out = []
    for speakers in waves(members, held):
        top = f"{shared_folder(members.sparkSession)}/corvane-{uuid.uuid4().hex}"
        mine = reduce(lambda a, b: a | b, (F.col("speaker_id").eqNullSafe(s) for s in speakers), F.lit(False))
        try:
            out.append(kept(use(package(members.where(mine), f"{top}/shards"), f"{top}/shards"), f"{top}-rows"))
        finally:
            fs, base = store(top)
            if fs.get_file_info(base).type == pafs.FileType.Directory:
                fs.delete_dir(base)
    return reduce(DataFrame.unionByName, out)
