"""Members of archives as an index table, and their bytes by ranged reads.

index() has a row for each file in tar and zip archives: where it lies and how long it is. An uncompressed tar of more than `range_bytes` is
indexed by several tasks. A task looks for the first header in its range (blocks of 512 bytes whose checksum is right) and lists the
members from there to the range's end. What looks like a header may be part of a payload, so this is a guess; it is checked by going
through the ranges of an archive in order: a range begins where the one before ends, and where that isn't the guess its members are
listed anew. Long payloads are jumped over. A zip is indexed from its
central directory, a compressed tar by reading it through, in one task each.

An archive that can't be read is a row with `error` and no name; the others go on. content() reads the bytes of the rows it is given and no others,
neighbours together. Files are opened through pyarrow, whatever store they are in, or by an `opener` that is passed in.
"""

from __future__ import annotations

import struct
import tarfile
import uuid
import zipfile
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.errors import DatasetReadError
from corvane.functions.text import filename, folder
from corvane.objects import store
from corvane.operators.numbering import kept, settled, shared_folder

#: Fixed values of the formats.
BLOCK, LOCAL_HEAD, LOCAL_MAGIC = 512, 30, b"PK\x03\x04"
FOUND = "archive string, name string, size bigint, offset bigint, stored bigint, method string, error string"
#: Bytes between members that are read rather than jumped over, and bytes that are read together at most.
GAP, TOGETHER = 64 << 10, 8 << 20
#: Headers are read with what follows them, up to AHEAD bytes, while payloads are no longer than SHORT. Members that tarfile goes on with.
AHEAD, SHORT, SLOW = 1 << 20, 2048, 1000
RANGE = "begin bigint, end bigint, at bigint, exit bigint"
WALKED = f"archive string, {RANGE}, name string, size bigint, offset bigint, error string"


def opened(path: str):
    """A file to read at any place."""
    if ":" not in path.split("/")[0]:
        return pafs.LocalFileSystem().open_input_file(path)
    fs, name = pafs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.open_input_file(name)


def _is_header(block: bytes) -> bool:
    try:
        tarfile.TarInfo.frombuf(block, "utf-8", "surrogateescape")
        return True
    except tarfile.HeaderError:
        return False


def kind_of(f) -> tuple[int, str]:
    """Size and kind of an archive: zip, tar, or stream (a compressed tar)."""
    size = f.seek(0, 2)
    size = f.tell() if size is None else size
    f.seek(0)
    head = f.read(BLOCK)
    if head[:2] == b"PK":
        return size, "zip"
    if len(head) == BLOCK and (_is_header(head) or not any(head)):
        return size, "tar"
    f.seek(0)
    with tarfile.open(fileobj=f, mode="r:*"):
        return size, "stream"


def _plain(head: bytes) -> tuple[str, int] | None:
    """Name and size of a file whose header has no more to it; None for others, which tarfile is asked about."""
    if len(head) != BLOCK or head[156] not in b"0\0" or head[345] or not head.isascii():
        return None
    try:
        stored, size = (int(head[i:j].partition(b"\0")[0], 8) for i, j in ((148, 156), (124, 136)))
    except ValueError:
        return None
    name = head[:100].partition(b"\0")[0]
    # 512 bytes below 128 sum up to less than adler32's modulus, so its low half is their sum and 1; the checksum's own bytes count as spaces
    if stored != (zlib.adler32(head) & 0xFFFF) - 1 - sum(head[148:156]) + 8 * 32 or size < 0 or name.endswith(b"/"):
        return None
    return name.decode(), size


def walk(f, start: int, end: int) -> Iterator[tuple[int, str, int, int, bool]]:
    """The members of a tar whose headers begin from start, which is such a place, to before end, and the one after, whatever they are: where the
    header begins, name, size, where the payload begins, whether it's a file. Headers of plain files are read here, several at a time while payloads
    are short; whatever else there is (long names, ends, faults) is left to tarfile, some members after it too."""
    at, last, data, base, ahead = start, None, b"", 0, BLOCK
    while True:
        if not base <= at <= base + len(data) - BLOCK:
            f.seek(at)
            data, base = f.read(min(ahead, max(0, end - at) + BLOCK)), at
        if plain := _plain(data[at - base : at - base + BLOCK]):
            name, size = plain
            yield at, name, size, at + BLOCK, True
            if at >= end:
                return
            length = -(-size // BLOCK) * BLOCK
            last, at, ahead = at, at + BLOCK + length, min(2 * ahead, AHEAD) if length <= SHORT else BLOCK
            continue
        # from the member before, so that a payload which breaks off is noticed
        f.seek(at if last is None else last)
        with tarfile.open(fileobj=f, mode="r:") as t:
            if last is not None:
                t.next()
            n = 0
            while n < SLOW or t.pax_headers:  # global ones hold for all that follow
                if (m := t.next()) is None:
                    return
                t.members.clear()  # else all are kept
                yield m.offset, m.name, m.size, m.offset_data, m.isfile()
                if m.offset >= end:
                    return
                last, at, n = m.offset, t.offset, n + 1


def follow(f, start: int, end: int) -> int | None:
    """Where the first header at or after end is, if the one at start is a header; None if there is none."""
    at = None
    try:
        for at, *_ in walk(f, start, end):
            pass
    except tarfile.TarError:
        return None
    return at if at is not None and at >= end else None


def guess(f, start: int, end: int) -> int | None:
    """The first block in a range that looks like a header."""
    at = -(-start // BLOCK) * BLOCK
    f.seek(at)
    while at < end and (data := f.read(BLOCK * 128)):
        for i in range(0, len(data) - BLOCK + 1, BLOCK):
            if at + i >= end:
                return None
            if data[i] and _is_header(data[i : i + BLOCK]):
                return at + i
        at += len(data)
    return None


def _arrow(df: DataFrame, one: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """One row after another through a generator."""
    names = [x.split(" ")[0] for x in schema.split(", ")]
    kinds = [{"string": pa.string(), "bigint": pa.int64()}[x.split(" ")[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        out = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for got in one(*row):
                    rows.append(got)
                    if len(rows) >= 10_000:
                        yield out()
                        rows.clear()
        if rows:
            yield out()

    return df.mapInArrow(run, schema)


def index(archives: DataFrame, range_bytes: int = 64 << 20, opener: Callable = opened, table: str | None = None) -> DataFrame:
    """archive, prefix, filename, frame_index, name, size, offset (of the payload; of a zip's local header; null in a compressed tar), stored
    (bytes there), method, error for archives(archive), a path or URI each. Files outside any folder of their archive are left out. The rows are
    written as a table (beside those of the ranges), to the folder `table` or to one in the shared folder; anew, beside it, if ranges weren't guessed right."""

    def probe(path: str) -> Iterator[tuple]:
        try:
            with opener(path) as f:
                yield (path, *kind_of(f), None)
        except (OSError, tarfile.TarError, zipfile.BadZipFile, EOFError, ValueError, zlib.error) as e:
            yield path, None, None, f"{path} can't be opened: {e}"

    def list_whole(path: str, kind: str) -> Iterator[tuple]:
        try:
            with opener(path) as f:
                if kind == "zip":
                    for z in zipfile.ZipFile(f).infolist():
                        if not z.is_dir():
                            yield path, z.filename, z.file_size, z.header_offset, z.compress_size, f"zip {z.compress_type}", None
                else:
                    with tarfile.open(fileobj=f, mode="r:*") as t:
                        while (m := t.next()) is not None:
                            t.members.clear()
                            if m.isfile():
                                yield path, m.name, m.size, None, None, "stream", None
        except (OSError, tarfile.TarError, zipfile.BadZipFile, EOFError, ValueError, zlib.error) as e:
            yield path, None, None, None, None, None, f"{path} can't be read: {e}"

    def walked(path: str, begin: int, end: int, at: int | None, several: int) -> Iterator[tuple]:
        """The members of a range from `at`, or from what looks like its first header; if it's one of several, then a row of the range, with the next
        one's first header."""
        after = error = None
        try:
            with opener(path) as f:
                at = guess(f, begin, end) if at is None else at
                for head, name, size, offset, is_file in walk(f, at, end) if at is not None else ():
                    if head >= end:
                        after = head
                    elif is_file:
                        yield path, begin, None, None, None, name, size, offset, None
        except (OSError, tarfile.TarError) as e:
            error = f"{path} can't be read: {e}"
        if several or error:
            yield path, begin, end if several else None, at, after, None, None, None, error

    def mistaken(ranges: pd.DataFrame) -> pd.DataFrame:
        """Ranges that don't begin where was thought, with where they do; null if no header begins in them."""
        path, at, out, f = ranges["archive"].iloc[0], 0, [], None
        for r in ranges.sort_values("begin").itertuples():
            if at is None or at >= r.end:
                out.append((path, r.begin, r.end, None))
            elif not pd.isna(r.at) and at == r.at:
                at = None if pd.isna(r.exit) else int(r.exit)
            else:
                out.append((path, r.begin, r.end, at))
                f = f or opener(path)
                at = follow(f, at, r.end)
        if f is not None:
            f.close()
        return pd.DataFrame(out, columns=["archive", "begin", "end", "at"]).astype({"at": "Int64"})

    n = max(1, min(archives.count(), 20_000))
    probed = settled(_arrow(archives.select("archive").repartition(n), probe, "archive string, size bigint, kind string, error string"))
    whole = F.lit(0).cast("bigint")
    small = probed.where(f"kind = 'tar' and size <= {range_bytes}").select("archive", whole.alias("begin"), F.col("size").alias("end"), whole.alias("at"), whole.alias("several"))
    begin = F.explode(F.sequence(whole, F.col("size") - 1, F.lit(range_bytes).cast("bigint"))).alias("begin")
    large = probed.where(f"kind = 'tar' and size > {range_bytes}").select("archive", "size", begin)
    large = large.select("archive", "begin", F.least("size", F.col("begin") + range_bytes).alias("end"), F.when(F.col("begin") == 0, whole).alias("at"), F.lit(1).cast("bigint").alias("several"))
    spread = lambda ranges, many: _arrow(ranges.repartition(min(many, 20_000), "archive", "begin"), walked, WALKED)
    tars = spread(small, n)
    if many := large.count():
        tars = tars.unionByName(spread(large, many))
    others = _arrow(probed.where("kind in ('zip', 'stream')").select("archive", "kind").repartition(n), list_whole, FOUND)
    bad = probed.where("error is not null").select("archive", "error")
    found = _tar_rows(tars).unionByName(others, allowMissingColumns=True).unionByName(bad, allowMissingColumns=True)
    table = table or f"{shared_folder(archives.sparkSession)}/corvane-{uuid.uuid4().hex}"
    rows = kept(_shaped(found), table)
    if many:
        wrong = settled(rows.where("end is not null").groupBy("archive").applyInPandas(mistaken, "archive string, begin bigint, end bigint, at bigint"))
        if again := wrong.count():
            anew = _shaped(_tar_rows(spread(wrong.where("at is not null").withColumn("several", whole), again)))
            rows = kept(rows.join(wrong, ["archive", "begin"], "left_anti").unionByName(anew), f"{table}-anew")
            fs, path = store(table)
            fs.delete_dir(path)
    return rows.where("name is not null or error is not null").drop(*(x.split(" ")[0] for x in RANGE.split(", ")))


def _tar_rows(tars: DataFrame) -> DataFrame:
    return tars.withColumns({"stored": F.col("size"), "method": F.when(F.col("name").isNotNull(), "tar")})


def _shaped(found: DataFrame) -> DataFrame:
    """Rows as index() has them, and the ranges' columns; files outside any folder aren't in it."""
    prefix = folder(F.col("name"))
    found = found.where((prefix != "") | F.col("error").isNotNull() | F.col("end").isNotNull())
    frame = F.when(filename(F.col("name")).rlike(r"^[0-9]+\.jpg\z"), F.regexp_extract(filename(F.col("name")), "^[0-9]+", 0).try_cast("int"))
    ranges = [x.split(" ")[0] for x in RANGE.split(", ")]
    return found.select("archive", F.concat(prefix, F.lit("/")).alias("prefix"), filename(F.col("name")).alias("filename"), frame.alias("frame_index"), "name", "size", "offset", "stored", "method", "error", *ranges)


def of_folder(spark: SparkSession, folder_: str, suffix: str = ".tar", speakers: list[str] | None = None, **options) -> DataFrame:
    """index() of the archives in a folder, or of some speakers' there, with speaker_id: the archive's name without its suffix."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder_).select(F.col("path").alias("archive"))
    name = F.substring_index("archive", "/", -1)  # a pattern would try every place of a long path, for every member
    speaker = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    paths = paths if speakers is None else paths.where(speaker.isin(speakers))
    return index(paths, **options).select(speaker.alias("speaker_id"), "*")


def faults(rows: DataFrame) -> DataFrame:
    """archive, error for archives that can't be read or have two members of one name."""
    twice = rows.where("name is not null").groupBy("archive", "name").agg(F.count("*").alias("n")).where("n > 1").select("archive", F.concat("archive", F.lit(" has two members "), "name").alias("error"))
    return rows.where("error is not null").select("archive", "error").unionByName(twice).groupBy("archive").agg(F.min("error").alias("error"))


def sound(rows: DataFrame) -> DataFrame:
    """The rows, or an error for the first archive at fault."""
    bad = faults(rows).orderBy("archive").take(1)
    if bad:
        raise DatasetReadError(bad[0]["error"])
    return rows.drop("error")


class _Files:
    """The files that a task has open, two at most."""

    def __init__(self, opener: Callable):
        self.opener, self.files = opener, OrderedDict()

    def __getitem__(self, path: str):
        if path not in self.files:
            if len(self.files) >= 2:
                self.files.popitem(last=False)[1].close()
            self.files[path] = self.opener(path)
        self.files.move_to_end(path)
        return self.files[path]

    def close(self) -> None:
        for f in self.files.values():
            f.close()


def _unpacked(data: bytes, method: str, size: int) -> bytes:
    """A member's bytes from what lies in its archive."""
    if method == "tar":
        return data
    if data[:4] != LOCAL_MAGIC:
        raise DatasetReadError("there is no local header")
    skip = LOCAL_HEAD + sum(struct.unpack("<HH", data[26:30]))
    if method == "zip 0":
        return data[skip : skip + size]
    return zlib.decompressobj(-15).decompress(data[skip:], size + 1)


def _read(files: _Files, rows: list[dict], limit: int) -> list[tuple[bytes | None, str | None]]:
    """Content and error of each row."""
    out: list[tuple[bytes | None, str | None]] = [(None, None)] * len(rows)
    by: dict[tuple, list[int]] = {}
    for i, r in enumerate(rows):
        if r["size"] > limit:
            out[i] = None, f"Oversized member {r['name']}: {r['size']} bytes"
        else:
            by.setdefault((r["archive"], r["method"] not in ("tar", "zip 0", "zip 8")), []).append(i)
    for (path, whole), mine in by.items():
        try:
            f = files[path]
            if whole:  # there is no place to go to: by name
                names = {rows[i]["name"]: i for i in mine}
                f.seek(0)
                if rows[mine[0]]["method"] == "stream":
                    with tarfile.open(fileobj=f, mode="r:*") as t:
                        while (m := t.next()) is not None:
                            t.members.clear()
                            if m.name in names:
                                out[names[m.name]] = _checked(rows[names[m.name]], t.extractfile(m).read())
                else:
                    z = zipfile.ZipFile(f)
                    for name, i in names.items():
                        out[i] = _checked(rows[i], z.read(name))
                continue
            mine.sort(key=lambda i: rows[i]["offset"])
            # before a zip's data are a header, the name and extra fields of unknown length; where these are over 256 bytes it is read again
            length = lambda i: rows[i]["stored"] + (0 if rows[i]["method"] == "tar" else LOCAL_HEAD + len(rows[i]["name"].encode()) + 256)
            while mine:
                begin = rows[mine[0]]["offset"]
                end, n = begin + length(mine[0]), 1
                while n < len(mine) and rows[mine[n]]["offset"] <= end + GAP and rows[mine[n]]["offset"] + length(mine[n]) - begin <= TOGETHER:
                    end, n = max(end, rows[mine[n]]["offset"] + length(mine[n])), n + 1
                f.seek(begin)
                data = f.read(end - begin)
                for i in mine[:n]:
                    r = rows[i]
                    a = r["offset"] - begin
                    part = data[a : a + length(i)]
                    if r["method"] != "tar" and part[:4] == LOCAL_MAGIC and len(part) < (need := LOCAL_HEAD + sum(struct.unpack("<HH", part[26:30])) + r["stored"]):
                        f.seek(r["offset"])
                        part = f.read(need)
                    out[i] = _checked(r, _unpacked(part, r["method"], r["size"]))
                mine = mine[n:]
        except (OSError, tarfile.TarError, zipfile.BadZipFile, EOFError, ValueError, zlib.error, DatasetReadError) as e:
            for i in mine:
                out[i] = None, f"{rows[i]['name']} can't be read: {e}"
    return out


def _checked(row: dict, data: bytes) -> tuple[bytes | None, str | None]:
    return (data, None) if len(data) == row["size"] else (None, f"Truncated member {row['name']}: {len(data)} of {row['size']} bytes")


def content(rows: DataFrame, max_member_bytes: int = 16 << 20, strict: bool = True, opener: Callable = opened) -> DataFrame:
    """rows of an index with content. strict: what can't be read is an error; else the row has it in `error`, and content is null."""
    if max_member_bytes < 1:
        raise ValueError("max_member_bytes must be positive")
    rows = rows.drop("error")
    schema = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])
    needed = ["archive", "name", "size", "offset", "stored", "method"]
    at = [rows.columns.index(c) for c in needed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(opener)
        try:
            for batch in batches:
                records = [dict(zip(needed, x)) for x in zip(*(batch.column(i).to_pylist() for i in at))]
                i = 0
                while i < len(records):
                    n, size = i, 0
                    while n < len(records) and (n == i or size + records[n]["size"] <= TOGETHER):
                        size, n = size + records[n]["size"], n + 1
                    got = _read(files, records[i:n], max_member_bytes)
                    if strict and any(e for _, e in got):
                        raise DatasetReadError(next(e for _, e in got if e))
                    part = batch.slice(i, n - i)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([d for d, _ in got], pa.binary()), pa.array([e for _, e in got], pa.string())], names=schema.fieldNames())
                    i = n
        finally:
            files.close()

    out = rows.mapInArrow(run, schema)
    return out.drop("error") if strict else out
