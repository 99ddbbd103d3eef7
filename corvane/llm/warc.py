"""WARC: a deterministic sharded writer, and its reader.

Writer: records are ranged by page id into shards of about `shard_bytes` (payload and headers), sorted within each, and written as
archives of one gzip member a record. Where shards begin comes from running sums of bytes over the ids in order, each range of ids summed by
a task of its own. A shard rolls over to another file when its compressed size passes `roll_bytes`.
Headers and digests are made anew from the payload, with a fixed date, so the same rows give the same bytes however the
cluster runs. A task writes under a name of its own attempt and renames when the file is whole; a shard's last act is its
manifest, also renamed into place. A task that runs twice thus writes the same files twice; readers go by the manifests.

Of records with equal payloads of at least `least_bytes` bytes the one with the largest page id is a response, the others
are revisits of it; shorter ones are all responses. Null html is an empty payload. Rows that repeat a page id are each
written; of several payload-equal ones with the largest page id the one whose url has the least hash is the response (rows
that are alike in all three columns share their type). A row without page id is written as a response with an
empty target id, in shards of their own after the others, dealt by its payload (copies that would fill a shard by their place in the input). Other columns are ignored. An empty table gives no archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import arrow_map, cut, filesystem, new_folder, partitions

RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
#: Fixed values of the format.
VERSION, DATE, PROFILE = b"WARC/1.1", b"2024-01-01T00:00:00Z", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Params:
    """least_bytes: the shortest payload that can be a revisit. shard_bytes: of payload and headers in a shard, about. head_bytes: that a record's headers
    count. roll_bytes: compressed size at which a file is closed. level: of gzip. tasks: that write, at most."""

    least_bytes: int = 0
    shard_bytes: int = 64 << 20
    roll_bytes: int = 32 << 20
    level: int = 4
    head_bytes: int = 512
    tasks: int = 20_000


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> bytes:
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{digest}")).encode()


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head but no payload."""
    clean = lambda x: (x or "").replace("\r", " ").replace("\n", " ").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [
        VERSION,
        b"WARC-Type: " + kind.encode(),
        b"WARC-Record-ID: " + record_id(page_id, digest),
        b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + clean(url),
        b"WARC-Identified-Payload-Type: text/html",
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"WARC-Block-Digest: sha1:" + bare_digest(block).encode(),
        b"X-Page-Id: " + (b"" if page_id is None else b"%d" % page_id),
        b"X-Payload-Length: %d" % len(payload),
    ]
    if kind == "revisit":
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + record_id(refers_to, digest), b"X-Refers-To-Page-Id: %d" % refers_to]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def sized(pages: DataFrame) -> DataFrame:
    """page_id, url, html (binary), sha (of the payload), bytes, tie (of the url)."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    return rows.select("*", F.unhex(F.sha1("html")).alias("sha"), F.octet_length("html").cast("bigint").alias("bytes"), F.xxhash64("url").alias("tie"))


def revisits(rows: DataFrame, p: Params) -> DataFrame:
    """page_id, sha, tie, refers_to of the pages that revisit another. Payloads don't move: only ids and digests do; maxima are partial
    before the shuffle, and the join back is on the digest, whose skew adaptive execution splits."""
    narrow = rows.where(f"page_id is not null and bytes >= {p.least_bytes}").select("page_id", "sha", "tie")
    first = narrow.groupBy("sha").agg(F.max(F.struct("page_id", (-F.col("tie")).alias("tie"))).alias("first"), F.count("*").alias("copies")).where("copies > 1").select("sha", F.col("first.page_id").alias("refers_to"), (-F.col("first.tie")).alias("main"))
    return narrow.join(first, "sha").where("page_id <> refers_to or tie <> main").select("page_id", "sha", "tie", "refers_to").distinct()


def ranges(rows: DataFrame, p: Params) -> np.ndarray:
    """Ascending page ids at which shards begin: an id begins one if a multiple of shard_bytes lies in the running sum up to it. The ids are summed,
    ordered and summed up by ranges; the driver gets the sum of each range, and of each shard its first id (8 bytes a shard)."""
    ids = rows.where("page_id is not null").groupBy("page_id").agg(F.sum(F.col("bytes") + p.head_bytes).alias("bytes"))
    dealt = cut(ids.repartitionByRange(partitions(rows.sparkSession), "page_id").sortWithinPartitions("page_id").withColumn("part", F.spark_partition_id()))
    totals = sorted(map(tuple, dealt.groupBy("part").agg(F.sum("bytes")).collect()))
    before = dict(zip((part for part, _ in totals), np.cumsum([0, *(n for _, n in totals)]).tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = last = None  # bytes before the next id; the shard of the one before, begun in this range
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.asarray(batch.column(1))
            done = before[batch.column(2)[0].as_py()] if done is None else done
            shard = (done + np.cumsum(size) - size) // p.shard_bytes
            i = np.flatnonzero(np.diff(shard, prepend=-1 if last is None else last))
            done, last = done + int(size.sum()), int(shard[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), pa.array(shard[i])], names=["page_id", "shard"])

    starts = dealt.mapInArrow(run, "page_id bigint, shard bigint").groupBy("shard").agg(F.min("page_id").alias("page_id"))
    return np.sort(np.asarray(starts.select("page_id").toArrow().column(0), np.int64))


def nameless(rows: DataFrame, p: Params) -> tuple[int, DataFrame]:
    """How many shards rows without page id need, and sha, tie, spread of the copies among these that need over one for themselves (at most as
    many rows as shards)."""
    groups = rows.where("page_id is null").groupBy("sha", "tie").agg(F.sum(F.col("bytes") + p.head_bytes).alias("s"))
    groups = cut(groups)
    total = groups.agg(F.sum("s")).first()[0] or 0
    return -(-total // p.shard_bytes), groups.where(F.col("s") > p.shard_bytes).select("sha", "tie", F.ceil(F.col("s") / p.shard_bytes).cast("int").alias("spread"))


def write(pages: DataFrame, folder: str, p: Params = Params()) -> DataFrame:
    """Write pages(page_id, url, html) as archives below folder; returns the manifest: shard, file, records, bytes, sha256, one row a file."""
    rows = sized(pages)
    starts = ranges(rows, p)
    more, copies = nameless(rows, p)
    n = max(1, len(starts) + more)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(starts, ids.fillna(0).to_numpy(np.int64), side="right"), 1)).astype("int32")

    # what makes a page a revisit travels to its shard as a row of its own, ahead of the page, so payloads are shuffled once
    names = ["page_id", "sha", "tie", "url", "html", "refers_to"]
    roles = revisits(rows, p).select("page_id", "sha", "tie", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"), "refers_to")
    both = roles.unionByName(rows.withColumn("refers_to", F.lit(None).cast("bigint")).select(*names))
    tasks = min(n, p.tasks)
    # neighbouring shards share a task if there are more shards than tasks
    task = F.floor((F.col("shard").cast("bigint") - 1) * tasks / n).cast("int")
    if more:
        # a copy's place among its shards is its row's in the input: copies are alike, so the files are too
        both = both.join(F.broadcast(copies), ["sha", "tie"], "left")
        own = F.pmod(F.xxhash64("sha", "tie") + F.when(F.col("spread").isNotNull(), F.pmod(F.monotonically_increasing_id(), "spread")).otherwise(0), F.lit(more)).cast("int")
        both = both.withColumn("shard", F.when(F.col("page_id").isNull(), len(starts) + 1 + own).otherwise(shard("page_id"))).select(*names, "shard")
    else:
        both = both.withColumn("shard", shard("page_id"))
    dealt = both.repartitionById(tasks, task).sortWithinPartitions("shard", "page_id", "sha", "tie", F.col("refers_to").desc_nulls_last())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        out: _Roll | None = None
        role: tuple = ()
        for batch in batches:
            for page, sha, tie, url, html, ref, s in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if ref is not None:
                    role = (page, sha, tie, ref)
                    continue
                if out is None or out.shard != s:
                    if out is not None:
                        yield out.end()
                    out = _Roll(fs, base, s, p)
                to = role[3] if role[:3] == (page, sha, tie) else None
                out.add(record(page, url, html, "response" if to is None else "revisit", bare_digest(html), to))
        if out is not None:
            yield out.end()

    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    return cut(dealt.mapInArrow(run, "shard int, file string, records bigint, bytes bigint, sha256 string"))


class _Roll:
    """The files of one shard."""

    def __init__(self, fs: pafs.FileSystem, base: str, shard: int, p: Params):
        self.fs, self.base, self.shard, self.p, self.files, self.out = fs, base, shard, p, [], None
        self.tag = uuid.uuid4().hex

    def add(self, rec: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{len(self.files):04d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.base}/_{self.name}.{self.tag}")
            self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0
            self._put(self._member(b"\r\n".join([VERSION, b"WARC-Type: warcinfo", b"WARC-Date: " + DATE, b"WARC-Record-ID: " + record_id(None, self.name), b"Content-Type: application/warc-fields", b"Content-Length: 0"]) + b"\r\n\r\n\r\n\r\n"))
        self._put(self._member(rec))
        self.records += 1
        if self.bytes >= self.p.roll_bytes:
            self._close()

    def _member(self, rec: bytes) -> bytes:
        return gzip.compress(rec, self.p.level, mtime=0)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def _close(self) -> None:
        self.out.close()
        self.fs.move(f"{self.base}/_{self.name}.{self.tag}", f"{self.base}/{self.name}")
        self.files.append((self.name, self.records, self.bytes, self.sha.hexdigest()))
        self.out = None

    def end(self) -> pa.RecordBatch:
        if self.out is not None:
            self._close()
        name = f"{self.base}/manifest-{self.shard:06d}.json"
        with self.fs.open_output_stream(f"{name}.{self.tag}") as f:
            f.write(json.dumps([dict(zip(("file", "records", "bytes", "sha256"), x)) for x in self.files]).encode())
        self.fs.move(f"{name}.{self.tag}", name)
        cols = list(zip(*self.files))
        return pa.RecordBatch.from_arrays([pa.array([self.shard] * len(self.files), pa.int32()), pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3])], names=["shard", "file", "records", "bytes", "sha256"])


def members(stream, sha) -> Iterator[bytes]:
    """The gzip members of a file, one at a time; sha takes in all its bytes."""
    d, got = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        sha.update(chunk)
        while chunk:
            got.append(d.decompress(chunk))
            chunk = d.unused_data
            if d.eof:
                yield b"".join(got)
                d, got = zlib.decompressobj(31), []
    if any(got):
        raise EOFError("a gzip member is cut short")


def parsed(rec: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Headers and block of a record."""
    head, _, rest = rec.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(x.split(b": ", 1) if b": " in x else (x.rstrip(b":"), b"") for x in lines[1:])
    return headers, rest[: int(headers[b"Content-Length"])]


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """file, records, bytes, sha256 of each archive that the shards' manifests in folder name; other files there are not committed."""
    fs, base = filesystem(folder)
    there = any(x.base_name.startswith("manifest-") and x.base_name.endswith(".json") for x in fs.get_file_info(pafs.FileSelector(base)))
    schema = "file string, records bigint, bytes bigint, sha256 string"
    return spark.read.schema(schema).option("multiLine", True).json(f"{folder}/manifest-*.json") if there else spark.createDataFrame([], schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record in the archives that the manifests in folder list, checked: the files' and blocks' digests, and the payload's
    for responses. Files are streamed member by member."""
    files = cut(manifests(spark, folder).select("file", "records", "sha256"))
    files = files.repartition(max(1, min(files.count(), 20_000)))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        fs, base = filesystem(folder)
        for file, records, digest_ in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows: list[tuple] = []
            total, sha = 0, hashlib.sha256()
            with fs.open_input_stream(f"{base}/{file}", compression=None) as f:
                for rec in members(f, sha):
                    h, block = parsed(rec)
                    if h[b"WARC-Type"] == b"warcinfo":
                        continue
                    total += 1
                    digest = h[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
                    size = int(h[b"X-Payload-Length"])
                    if h[b"WARC-Block-Digest"] != b"sha1:" + bare_digest(block).encode():
                        raise ValueError(f"{file}: the block of {h[b'WARC-Record-ID']!r} doesn't match its digest")
                    if h[b"WARC-Type"] == b"response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest, size = bare_digest(payload), len(payload)
                        if h[b"WARC-Payload-Digest"] != b"sha1:" + digest.encode():
                            raise ValueError(f"{file}: the payload of {h[b'WARC-Record-ID']!r} doesn't match its digest")
                    page, ref = h[b"X-Page-Id"], h.get(b"X-Refers-To-Page-Id")
                    rows.append((int(page) if page else None, size, digest, h[b"WARC-Type"].decode(), int(ref) if ref else None))
                    if len(rows) >= 5000:
                        yield _columns(rows)
                        rows = []
            if total != records:
                raise ValueError(f"{file} has {total} records; its manifest has {records}")
            if sha.hexdigest() != digest_:
                raise ValueError(f"{file} doesn't match its digest in the manifest")
            yield _columns(rows)

    return arrow_map(files, run, RECORD)


def _columns(rows: list[tuple]) -> dict:
    c = list(zip(*rows)) or [()] * 5
    return dict(zip(("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), (pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.string()), pa.array(c[4], pa.int64()))))


def round_trip(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """Write pages to a new folder and read the archives back."""
    folder = new_folder(pages.sparkSession, "warc")
    write(pages, folder, p)
    return read(pages.sparkSession, folder)
