"""Members of tar and zip archives as a Spark data source: spark.read.format("corvane_archive").load(folder).

A partition is one archive; of an uncompressed tar only headers are read unless content is asked for (option content), and then
only of members that the filters leave; compressed tars (.tgz, .tar.bz2, .tar.xz) are read through. Filters on speaker_id, prefix, filename and frame_index are pushed down
(spark.sql.python.filterPushdown.enabled): a speaker's filter leaves one archive.

Options: content (false), max_member_bytes (16 MiB), suffix (.tar or .zip), cache (a folder of the executor's own for copies,
reused while the size agrees).
"""

from __future__ import annotations

import hashlib
import os
import re
import shutil
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from corvane.errors import DatasetReadError
from corvane.schemas import MEMBER

FRAME = re.compile(r"[0-9]+\.jpg")


class Archive(InputPartition):
    def __init__(self, speaker: str, path: str):
        super().__init__(path)
        self.speaker, self.path = speaker, path


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://")
        self.content = options.get("content", "false").lower() == "true"
        self.limit = int(options.get("max_member_bytes", 16 << 20))
        if self.limit < 1:
            raise ValueError("max_member_bytes must be positive")
        self.suffix, self.cache = options.get("suffix", ".tar"), options.get("cache")
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in ("speaker_id", "prefix", "filename", "frame_index"):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        names = sorted(x for x in os.listdir(self.folder) if x.endswith(self.suffix)) if os.path.isdir(self.folder) else [os.path.basename(self.folder)]
        base = self.folder if os.path.isdir(self.folder) else os.path.dirname(self.folder)
        found = [Archive(x.removesuffix(self.suffix), f"{base}/{x}") for x in names]
        return [p for p in found if "speaker_id" not in self.wanted or p.speaker in self.wanted["speaker_id"]]

    def _local(self, path: str) -> str:
        if not self.cache:
            return path
        copy = os.path.join(self.cache, os.path.basename(path))
        if not os.path.isfile(copy) or os.path.getsize(copy) != os.path.getsize(path):
            os.makedirs(self.cache, exist_ok=True)
            part = f"{copy}.{uuid.uuid4().hex}"
            shutil.copyfile(path, part)
            os.replace(part, copy)
        return copy

    def read(self, partition: Archive) -> Iterator[tuple]:
        path = self._local(partition.path)
        seen: set[str] = set()
        with _open(path) as members:
            for name, size, offset, load in members:
                prefix, slash, filename = name.rpartition("/")
                if not slash:
                    continue
                if name in seen:
                    raise DatasetReadError(f"{path} has two members {name}")
                seen.add(name)
                row = {"speaker_id": partition.speaker, "prefix": f"{prefix}/", "filename": filename, "frame_index": int(filename[:-4]) if FRAME.fullmatch(filename) else None}
                if any(row[k] not in v for k, v in self.wanted.items()):
                    continue
                data = None
                if self.content:
                    if size > self.limit:
                        raise DatasetReadError(f"Oversized member {name}: {size} bytes")
                    data = load()
                    if len(data) != size:
                        raise DatasetReadError(f"Truncated member {name}: {len(data)} of {size} bytes")
                yield (*row.values(), size, offset, data)


class _open:
    """The file members of an archive: name, size, offset, and a function that reads it."""

    def __init__(self, path: str):
        self.path = path

    def __enter__(self) -> Iterator[tuple]:
        try:
            with open(self.path, "rb") as f:
                zipped = f.read(4) == b"PK\x03\x04"
            self.handle = zipfile.ZipFile(self.path) if zipped else tarfile.open(self.path, "r:*")
        except (tarfile.TarError, zipfile.BadZipFile, OSError, EOFError) as e:
            raise DatasetReadError(f"{self.path} can't be opened: {e}") from e
        h = self.handle
        if zipped:
            return ((i.filename, i.file_size, i.header_offset, lambda i=i: h.read(i)) for i in h.infolist() if not i.is_dir())
        return ((m.name, m.size, m.offset_data, lambda m=m: h.extractfile(m).read()) for m in h if m.isfile())

    def __exit__(self, *_) -> None:
        self.handle.close()


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corvane_archive"

    def schema(self):
        return MEMBER

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def members(spark: SparkSession, folder: str, content: bool = False, **options):
    register(spark)
    return spark.read.format("corvane_archive").options(content=str(content).lower(), **options).load(folder)


def digests(files: DataFrame) -> DataFrame:
    """files(path) with size and sha256, read on executors a MiB at a time, so that no file has to fit in memory; null for one that isn't
    there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path in b["path"]:
                try:
                    fs, name = pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)
                    sha, size = hashlib.sha256(), 0
                    with fs.open_input_stream(name, compression=None) as f:
                        while chunk := f.read(1 << 20):
                            sha.update(chunk)
                            size += len(chunk)
                    rows.append((path, size, sha.hexdigest()))
                except (OSError, ValueError):
                    rows.append((path, None, None))
            yield pd.DataFrame(rows, columns=["path", "size", "sha256"]).astype({"size": "Int64"})

    return files.select("path").mapInPandas(run, "path string, size bigint, sha256 string")


def of_speaker(members, speaker: str):
    """Members of a shared archive below the speaker's folder; all of them if none are."""
    mine = members.where(f"prefix like '{speaker}/%' or prefix like '%/{speaker}/%'")
    return mine if mine.take(1) else members
