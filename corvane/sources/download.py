"""Downloads on executors, through a transport that is passed in: open_url(url, headers) gives (status, headers, chunks).

A file is fetched in ranges of bytes, each a part of its own in a folder that all executors share. Parts that are there stay, so a range
that failed is fetched again alone, in this run or the next. When all are there a task streams them together, verifies the archive,
and renames it into place. What fails is a row with its error. Of the sources of a speaker's archive the next is tried for those alone that no source
before gave, video and audio each on their own.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.config import CorpusConfig
from corvane.errors import DownloadError
from corvane.operators.integrity import tar_fault, zip_fault
from corvane.operators.numbering import settled


def fetch(url: str, dest: str, open_url: Callable, c: CorpusConfig = CorpusConfig(), sleep: Callable[[float], None] = time.sleep) -> str:
    """Fetch url to dest unless it is there. A part left by an earlier attempt is resumed; a server that sends the whole again restarts it."""
    target, part = Path(dest), Path(f"{dest}.part")
    if target.exists():
        return dest
    target.parent.mkdir(parents=True, exist_ok=True)
    error: Exception | None = None
    for attempt in range(c.retries):
        if attempt:
            sleep(min(c.retry_max_delay, c.retry_delay * c.retry_factor ** (attempt - 1)))
        have = part.stat().st_size if part.exists() else 0
        try:
            status, headers, chunks = open_url(url, {"Range": f"bytes={have}-"} if have else {})
            if status not in (200, 206):
                raise DownloadError(f"HTTP {status} for {url}")
            have = have if status == 206 else 0
            with part.open("ab" if have else "wb") as f:
                for chunk in chunks:
                    f.write(chunk)
            length = int(headers.get("content-length", 0) or 0)
            if length and part.stat().st_size < have + length:
                raise DownloadError(f"{url} broke off at {part.stat().st_size} of {have + length} bytes")
            os.replace(part, target)
            return dest
        except (DownloadError, OSError) as e:
            error = e
    raise DownloadError(f"{url}: {c.retries} attempts failed; the last: {error}")


def _attempts(c: CorpusConfig, sleep: Callable[[float], None]) -> Iterator[int]:
    for attempt in range(c.retries):
        if attempt:
            sleep(min(c.retry_max_delay, c.retry_delay * c.retry_factor ** (attempt - 1)))
        yield attempt


def length_of(url: str, open_url: Callable, c: CorpusConfig, sleep: Callable[[float], None]) -> int | None:
    """A file's bytes; None where the server doesn't give ranges."""
    error: Exception | None = None
    for _ in _attempts(c, sleep):
        try:
            status, headers, chunks = open_url(url, {"Range": "bytes=0-0"})
            total = headers.get("content-range", "").rpartition("/")[2]
            if status == 206 and total.isdigit():
                return int(total)
            if status in (200, 206):
                return None
            error = DownloadError(f"HTTP {status} for {url}")
        except OSError as e:
            error = e
    raise DownloadError(f"{url}: {c.retries} attempts failed; the last: {error}")


def fetch_range(url: str, part: str, begin: int, end: int, open_url: Callable, c: CorpusConfig, sleep: Callable[[float], None]) -> None:
    """Bytes [begin, end) of url as the file part, unless it is there whole."""
    if os.path.isfile(part) and os.path.getsize(part) == end - begin:
        return
    os.makedirs(os.path.dirname(part), exist_ok=True)
    error: Exception | None = None
    attempt = f"{part}.{uuid.uuid4().hex}"
    for _ in _attempts(c, sleep):
        try:
            status, _, chunks = open_url(url, {"Range": f"bytes={begin}-{end - 1}"})
            if status != 206:
                raise DownloadError(f"HTTP {status} for a range of {url}")
            with open(attempt, "wb") as f:
                for chunk in chunks:
                    f.write(chunk)
            if os.path.getsize(attempt) != end - begin:
                raise DownloadError(f"{url} broke off in the range from {begin}")
            os.replace(attempt, part)
            return
        except (DownloadError, OSError) as e:
            error = e
    if os.path.exists(attempt):
        os.unlink(attempt)
    raise DownloadError(f"{url}: {c.retries} attempts failed; the last: {error}")


def _mapped(df: DataFrame, one: Callable[..., tuple], schema: str) -> DataFrame:
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [one(*r) for r in b.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=names).astype({x: "Int64" for x, k in zip(names, (y.split(" ")[1] for y in schema.split(", "))) if k == "bigint"})

    return df.mapInPandas(run, schema)


def fetched(files: DataFrame, open_url: Callable, c: CorpusConfig = CorpusConfig(), part_bytes: int = 64 << 20, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """dest, error for files(url, dest, format): each file fetched and verified at its place in a folder that all executors share, or what went
    wrong. One that is there already is taken as it is."""
    parts = lambda dest: f"{dest}.parts"

    def measure(url: str, dest: str, format: str) -> tuple:
        try:
            return url, dest, format, -1 if os.path.exists(dest) else length_of(url, open_url, c, sleep), None
        except DownloadError as e:
            return url, dest, format, None, str(e)

    def take(url: str, dest: str, begin: int, end: int) -> tuple:
        try:
            if pd.isna(end):
                fetch(url, f"{parts(dest)}/0", open_url, c, sleep)
            else:
                fetch_range(url, f"{parts(dest)}/{int(begin)}", int(begin), int(end), open_url, c, sleep)
            return dest, None
        except DownloadError as e:
            return dest, str(e)

    def assemble(dest: str, format: str, begins: list, error: str | None) -> tuple:
        if error:
            return dest, error
        attempt = f"{dest}.{uuid.uuid4().hex}"
        try:
            with open(attempt, "wb") as out:
                for b in sorted(begins):
                    with open(f"{parts(dest)}/{b}", "rb") as f:
                        while chunk := f.read(1 << 20):
                            out.write(chunk)
            fault = {"zip": zip_fault, "tar": tar_fault}[format](attempt)
            if not fault:
                os.replace(attempt, dest)
            # parts that make no archive are of no use to a later attempt
            for x in os.listdir(parts(dest)):
                os.unlink(f"{parts(dest)}/{x}")
            os.rmdir(parts(dest))
            return dest, f"{dest}: {fault}" if fault else None
        except OSError as e:
            return dest, f"{dest}: {e}"
        finally:
            if os.path.exists(attempt):
                os.unlink(attempt)

    todo = files.select("url", "dest", "format").dropDuplicates(["dest"])
    n = max(1, min(todo.count(), 20_000))
    sized = settled(_mapped(todo.repartition(n, "dest"), measure, "url string, dest string, format string, size bigint, error string"))
    open_ = sized.where("error is null and (size is null or size > 0)")
    begins = F.when(F.col("size").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(part_bytes).cast("bigint")))
    end = F.when(F.col("size").isNotNull(), F.least(F.col("size"), F.col("begin") + part_bytes)).alias("end")
    ranges = open_.select("url", "dest", F.explode(begins).alias("begin"), "size").select("url", "dest", "begin", end)
    taken = settled(_mapped(ranges.repartition(max(1, min(ranges.count(), 20_000)), "dest", "begin"), take, "dest string, error string")).groupBy("dest").agg(F.min("error").alias("error"))
    ready = open_.drop("error").join(taken, "dest").select("dest", "format", begins.alias("begins"), "error")
    done = _mapped(ready.repartition(n, "dest"), assemble, "dest string, error string")
    empty = sized.where("size = 0 and error is null").select("dest", F.concat("dest", F.lit(" is empty")).alias("error"))
    return settled(done.unionByName(sized.where("error is not null or size = -1").select("dest", "error")).unionByName(empty))


def acquired(wanted: DataFrame, open_url: Callable, c: CorpusConfig = CorpusConfig(), **options) -> DataFrame:
    """speaker_id, kind, source, dest, error: for each speaker and kind of wanted(speaker_id, kind, priority, source, url, dest, format) the first
    source by priority that gives a sound archive, or the last one's error. A round for each priority; a file of several speakers is
    fetched once."""
    left, out = wanted, []
    for priority in [r[0] for r in wanted.select("priority").distinct().orderBy("priority").collect()]:
        mine = left.where(F.col("priority") == priority)
        got = settled(mine.join(fetched(mine, open_url, c, **options), "dest").select("speaker_id", "kind", "priority", "source", "dest", "error"))
        out.append(got)
        left = left.join(got.where("error is null").select("speaker_id", "kind"), ["speaker_id", "kind"], "left_anti")
    if not out:
        return wanted.select("speaker_id", "kind", "source", "dest", F.lit(None).cast("string").alias("error"))
    every = reduce(DataFrame.unionByName, out)
    best = F.min_by(F.struct("source", "dest", "error"), F.struct(F.col("error").isNotNull(), F.when(F.col("error").isNull(), F.col("priority")).otherwise(-F.col("priority")))).alias("x")
    return every.groupBy("speaker_id", "kind").agg(best).select("speaker_id", "kind", "x.*")
